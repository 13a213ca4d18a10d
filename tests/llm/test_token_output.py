import zlib

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from applens.llm import token_output as to
from applens.llm.queries import tokenizer_path
from llm_fixtures import docs  # noqa: F401  (a fixture)

PATH = tokenizer_path("word_bpe_49k.json")


def expected(rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_and_places(spark, docs):
    rows = [(5, "Hello  World it's\x1cfine x"), (1, None), (2, ""), (9, "word " * 20000), (3, "Ünïcode é <|endoftext|> a's"),
            (4, "x" * 5000), (7, " \t\n"), (8, "don't can't we'll 12345 ... !!! ́ z"), (11, "漢字かな交じり文 кириллица")]
    got = sorted(map(tuple, to.token_ids(docs(rows, extra=True), PATH).collect()))
    assert got == expected(sorted(rows))


def test_repeated_ids_and_empty_table(spark, docs):
    got = [tuple(r) for r in to.token_ids(docs([(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()]
    assert sorted((r[0] is not None, r[1], r[2]) for r in got) == [(False, 0, 2), (True, 2, 3), (True, 5, 3)]
    assert to.token_ids(docs([(1, "x")]).limit(0), PATH).count() == 0


def test_file_layout(spark, docs, tmp_dir):
    path = tmp_dir + "/ids"
    to.write_token_ids(docs([(i, f"text number {i} " * 50) for i in range(200)]), path, PATH, files=2)
    import glob
    meta = pq.ParquetFile(sorted(glob.glob(path + "/*.parquet"))[0]).metadata.row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert any("DICT" in e for e in by["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings
    assert by["doc_id"].has_offset_index and by["doc_id"].has_column_index
    plan = to.read_token_ids(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]


def test_words_forgotten_stay_right():
    enc = to.WordEncoder(PATH, words_kept=3)
    text = b"alpha beta gamma delta epsilon alpha " * 3
    assert enc.encode(text) == to.WordEncoder(PATH).encode(text) == enc.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(
    ["the,", "Ones.", "it's", "'s", "Σας", "İstanbul", "ŉ", "ﬁ", "e\u0301", "\u0301", "<|endoftext|>", "a<|startoftext|>.", "ß!!", "ÀÉ###", "x2y",
     "ª", "ǅ", "don't.", "end'", "a-b", "\x1c", "\x85", "\xa0", "\u2028"])), max_size=12))
def test_word_by_word_equals_whole_text(words):
    text = " ".join(words)
    enc = to._encoder(PATH)
    assert np.frombuffer(enc.encode(text.encode("utf-8", "replace")), "<u4").tolist() == enc._tok.encode(
        text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids
