"""URL filter: path rules first, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table, which is a parameter.
Host and path each give their 3- to 5-character n-grams, marked with the part
they come from and hashed into a fixed number of weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, tidy

FEATURE_BITS = 15
GRAMS = (3, 4, 5)

# The default labelled table: ordinary words of English and neighbouring languages that stand for each label, as hosts of one or two
# words and in paths of common shapes.  Both labels get the same prefixes, domains and paths, so only the words tell them apart.
_BLOCKED = (
    "adult xxx sex sexy porn porno nude erotic escort hentai fetish webcam milf camgirls casino poker slots roulette blackjack jackpot gamble "
    "gambling lottery bingo bet bets betting bookmaker wager wetten apuestas pills pharmacy viagra cialis steroids weightloss dietpills "
    "replica knockoff cheap free discount bargain win winner prize giveaway coupon spam farm linkfarm backlinks seo ads adserver adclick "
    "banner popup track tracker tracking clicks clickbait affiliate loans payday creditfix fastcash getrich bitcoinprofit forex warez "
    "torrent crack cracked keygen serial nulled pirate phish phishing malware virus trojan hack exploit scam").split()
_ALLOWED = (
    "news weather library garden museum school science recipes travel music history forum health theatre city river mountain journal review "
    "letters photo market university college hospital church village council community society institute research physics biology "
    "chemistry mathematics geology astronomy medicine nursing law court police railway station airport harbour bridge street house "
    "kitchen bakery coffee bread wine cheese fruit vegetable farmer forest ocean island beach lake valley desert winter summer spring "
    "autumn morning evening sunday family children parents teacher student reader writer author poetry novel story book press paper "
    "magazine radio television cinema film orchestra concert guitar piano dance painting gallery sculpture design architecture building "
    "engineering software computer network database developer code linux python camera bicycle football cricket tennis chess running "
    "swimming sailing climbing hiking camping fishing horse cattle animal nature planet energy water earth climate economy business "
    "finance insurance bank office company factory workshop furniture clothing shoes textile jewellery antique heritage archive record "
    "language english grammar dictionary translation zeitung nachrichten schule wissenschaft reise garten geschichte stadt gesundheit "
    "actualites cuisine voyage histoire ville sante jardin ecole noticias cocina viajes historia ciudad salud escuela mundo "
    # names of places, makers and people, which tell nothing and are allowed
    "london manchester bristol dublin edinburgh chicago boston seattle denver houston toronto montreal vancouver sydney melbourne "
    "auckland berlin hamburg munich cologne dresden vienna zurich geneva brussels antwerp amsterdam rotterdam copenhagen stockholm "
    "helsinki warsaw prague budapest athens lisbon madrid sevilla valencia barcelona milano torino firenze napoli toulouse bordeaux "
    "strasbourg marseille lyon nantes thames rhine danube siemens bosch nokia ericsson philips toyota honda nissan volvo renault peugeot "
    "michelin adidas nestle danone lufthansa samsung toshiba panasonic yamaha nikon canon kodak intel cisco oracle adobe mozilla debian "
    "ubuntu fedora postgres hadoop jenkins smith johnson williams taylor anderson thompson roberts edwards patterson hernandez rodriguez "
    "fernandez mueller schmidt schneider fischer weber wagner becker hoffmann dupont lefebvre moreau laurent rossi bianchi ferrari "
    "jansen vandenberg nielsen hansen eriksson lindqvist virtanen kowalski novak horvath papadopoulos silva santos oliveira").split()
_NEUTRAL = ("online", "my", "best", "24", "world", "the", "live", "top", "direct", "daily", "club", "center", "plus", "room", "time", "box")
_BEFORE = ("www.", "", "m.", "", "blog.", "www.", "en.", "shop.", "forum.")
_DOMAINS = ("com", "org", "net", "co.uk", "de", "com", "info", "io", "fr", "eu", "es", "edu.au", "com.br")
_PATHS = ("/", "", "/about", "/index.html", "/2019/04/{}", "/wiki/{}", "/{}/", "/category/{}/page/2", "/products/item-{}", "/articles/{}-in-brief",
          "/en/{}", "/user/profile", "/p/10482", "/blog/a-short-note-on-{}", "/search?q={}", "/de/kontakt", "/news/story-81734.html")


def _in_forms(words: Sequence[str], label: int, forms: int) -> list[tuple[str, int]]:
    """Each word alone, with another and with a neutral one, under ``forms`` prefixes, domains and paths, taken in turn."""
    out = []
    for i, w in enumerate(words):
        o, a, b = words[(i * 7 + 3) % len(words)], _NEUTRAL[i % len(_NEUTRAL)], _NEUTRAL[(i * 5 + 2) % len(_NEUTRAL)]
        for k, host in enumerate((w, w + o, f"{w}-{o}", a + w, w + b, f"{b}-{w}")):
            for f in range(forms):
                at = (i * 6 + k) * forms + f
                path = _PATHS[at * 5 % len(_PATHS)].format(words[(i * 11 + at) % len(words)])
                out.append((f"http{'s' * (at % 3 > 0)}://{_BEFORE[at % len(_BEFORE)]}{host}.{_DOMAINS[at * 3 % len(_DOMAINS)]}{path}", label))
    return out


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block or 0 to allow)."""
    return _in_forms(_BLOCKED, 1, 3) + _in_forms(_ALLOWED, 0, 3)


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, upper.lower()),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


@dataclass(frozen=True)
class Rule:
    action: str            # allow or block
    text: str              # host, then the path from its first slash on

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "".join(self.text.partition("/")[1:])

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits (the first of equal ones), else null."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: -len(r.text))[::-1]:
        fits = rule.fits(host, path)
        text, action = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.action).otherwise(action)
    return text, action


def gram_features(hosts: Sequence[bytes], paths: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram of every host and path."""
    rows, features = [], []
    for mark, parts in ((1, hosts), (2, paths)):
        joined = np.frombuffer(b"".join(b"^" + p + b"$" for p in parts), np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(p) + 2 for p in parts])
        for n in GRAMS:
            if len(joined) < n:
                continue
            h = np.full(len(joined) - n + 1, n * 4 + mark, np.uint64)
            for k in range(n):
                h = (h ^ joined[k:len(joined) - n + 1 + k]) * np.uint64(0x100000001B3)
            whole = owner[:len(h)] == owner[n - 1:]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            rows.append(owner[:len(h)][whole])
            features.append((h[whole] >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(features)


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def scores(self, hosts: Sequence[bytes], paths: Sequence[bytes]) -> np.ndarray:
        """Probability of the label block."""
        rows, features = gram_features(hosts, paths)
        n = np.maximum(np.bincount(rows, minlength=len(hosts)), 1)
        margin = np.bincount(rows, weights=self.weights[features], minlength=len(hosts)) / np.sqrt(n) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def split_url(url: str) -> tuple[bytes, bytes]:
    rest = url.partition("://")[2]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[end:].partition("?")[0].partition("#")[0]
    return rest[:end].lower().encode(), path.encode()


def fit_urls(labelled: Sequence[tuple[str, int]], ridge: float = 2e-4, steps: int = 300, rate: float = 4.0) -> UrlModel:
    """Logistic regression by accelerated gradient descent; the two labels weigh the same."""
    hosts, paths = zip(*(split_url(u) for u, _ in labelled))
    y = np.array([v for _, v in labelled], float)
    rows, features = gram_features(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=len(y)), 1))
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, bias, vw, vb = np.zeros(1 << FEATURE_BITS), 0.0, np.zeros(1 << FEATURE_BITS), 0.0
    for _ in range(steps):
        margin = np.bincount(rows, weights=w[features], minlength=len(y)) * scale + bias
        off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * share
        grad = np.bincount(features, weights=(off * scale)[rows], minlength=1 << FEATURE_BITS) + ridge * w
        vw, vb = 0.9 * vw - rate * grad, 0.9 * vb - rate * off.sum() * 0.1
        w, bias = w + vw, bias + vb
    return UrlModel(w, bias)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (list(byte_texts(batch.column(c))) for c in ("host", "path"))
            scores = pa.array(model.value.scores(hosts, paths))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])
    return run


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = (), labelled: Sequence[tuple[str, int]] | None = None,
               threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: the id, host, path, rule, verdict (allow or block), and the model's score.

    A rule decides where one fits, else the score does.  Null urls and urls
    without ``://`` have an empty host and path and are judged as such (no rule with a host fits
    them).  Repeated rows are judged each; other columns are not read; an empty table gives no rows.
    """
    model = pages.sparkSession.sparkContext.broadcast(fit_urls(labelled_urls() if labelled is None else labelled))
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = parts.mapInArrow(tidy(_score(model)), "page_id bigint, host string, path string, score double")
    rule, action = matching_rule(rules, F.col("host"), F.col("path"))
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(action, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
