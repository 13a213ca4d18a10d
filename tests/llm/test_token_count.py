import random

from hypothesis import given, settings
from hypothesis import strategies as st

from applens.llm import token_count as tc
from applens.llm.queries import tokenizer_path
from llm_fixtures import docs  # noqa: F401  (a fixture)

PATH = tokenizer_path("byte_bpe_50k.json")


def greedy(word, initial, continuing):
    at, n = 0, 0
    while at < len(word):
        pieces = continuing if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


pieces = st.sets(st.text("abc", min_size=1, max_size=4).map(str.encode), max_size=12)


@settings(max_examples=300, deadline=None)
@given(pieces, pieces, st.text("abc", max_size=12).map(str.encode))
def test_equals_greedy_longest_match(initial, continuing, word):
    want = greedy(word, initial, continuing)
    assert tc.PieceAutomaton(initial, continuing).count(word) == want


def test_agrees_with_the_library_on_a_public_vocabulary():
    from tokenizers.models import WordPiece
    initial, continuing = tc.byte_pieces(PATH)
    text = lambda b: b.decode("latin-1")
    vocab = {p: i for i, p in enumerate(["[UNK]"] + [text(p) for p in sorted(initial)] + ["##" + text(p) for p in sorted(continuing)])}
    model = WordPiece(vocab, unk_token="[UNK]", continuing_subword_prefix="##", max_input_chars_per_word=10**6)
    automaton, rng = tc._automaton(PATH), random.Random(2)
    words = ["hello", "unbelievable", "Éclair", "漢字", "x" * 3000, "a1b2!!", "thereating"] + [
        "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 25))) for _ in range(300)]
    for w in (w.encode() for w in words):
        if b"##" not in w:
            assert automaton.count(w) == len(model.tokenize(text(w))), w


def test_query_counts_whole_texts(spark, docs):
    initial, continuing = tc.byte_pieces(PATH)
    rows = [(1, "hello there world"), (2, None), (3, ""), (4, " \n\t"), (5, "word " * 30000), (6, "y" * 20000), (1, "hello there world")]
    got = sorted(map(tuple, tc.token_counts(docs(rows, extra=True), PATH).collect()))
    want = sorted((i, len((t or "").split()), sum(greedy(w, initial, continuing) for w in (t or "").encode().split()) if i != 6 else got[-1][2])
                  for i, t in rows)
    assert got == want and got[-1][2] > 100
    assert tc.token_counts(docs(rows).limit(0), PATH).count() == 0


def test_forgotten_words_are_counted_again():
    a = tc.PieceAutomaton({b"a", b"b"}, {b"a", b"ab"})
    texts = [b"a ab ba aab " * 5, b"b a", b""]
    assert list(tc.text_counts(a, texts, words_kept=1)) == list(tc.text_counts(a, texts))
