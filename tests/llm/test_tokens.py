"""Encoding, packing, binary files and counts against the library used plainly."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelake.llm.packing import difference, divide, pack
from tidelake.llm.token_counts import count_tokens
from tidelake.llm.token_files import read_token_files, write_token_files
from tidelake.llm.tokens import Encoder, default_tokenizer

ODD = [
    None, "", " ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "\n\n a\t\tb \n", "x<|endoftext|>y", "x <|endoftext|> y",
    "it's  we'll 'd", "é 世界　 b", "a\x1c b  c", "word " * 6000, "z" * 5000, "a\n\nb  \n\n  c", "Éé, éé. ñ; straße:", "word,\nnext. x² ½ Ⅷ 日本語, ", "same text", "same text",
]
SCHEMA = "doc_id bigint, text string, ids string, block int, size int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, a repeated id, and columns named like the operators' own."""
    rows = [(None if i == 3 else 7 if i == 5 else i, text, "x", 1, 2) for i, text in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_units_encode_as_whole_texts(library, spark, small):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for text, ids in zip(texts, Encoder(default_tokenizer()).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(library, text)


def test_unit_table_is_bounded(monkeypatch, library):
    monkeypatch.setattr("tidelake.llm.tokens._CACHE_BYTES", 1000)
    encoder = Encoder(default_tokenizer())
    for i in range(50):
        text = f"word{i} again word{i % 7}"
        assert np.frombuffer(next(iter(encoder.encode([text]))), "<u4").tolist() == plain(library, text)
        assert len(encoder.ids) < 20


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_get_whole_texts(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    for text, ids in zip(ODD, Encoder(path).encode(ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(library, text)


def test_differencing():
    assert sorted(difference([8, 7, 6, 5, 4], 5)) == [0, 1, 2, 3, 4]
    labels = difference([8, 7, 6, 5, 4], 2)
    sums = [sum(x for x, k in zip([8, 7, 6, 5, 4], labels, strict=True) if k == j) for j in range(2)]
    assert sorted(sums) == [14, 16]  # the known result of the method on this example
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 100, rng.integers(1, 60)).tolist()
        labels = divide(lengths, 100)
        assert np.bincount(labels, weights=lengths).max() <= 100
        assert len(labels) == len(lengths)
    assert divide([], 100) == []


@pytest.mark.parametrize("block", [1, 4, 512])
def test_pack_holds_every_id_once(odd, library, block):
    rows = pack(odd, block=block).collect()
    ids, windows = {}, {}
    for r in rows:
        part = np.frombuffer(r.ids, "<u4").tolist()
        assert len(part) == r.length > 0
        ids.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, part))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        assert [x for x, _ in sorted(pieces)] == np.cumsum([0, *[n for _, n in sorted(pieces)]])[:-1].tolist()
        assert sum(n for _, n in pieces) <= 2048
    texts = sorted(str(plain(library, text) + [1]) for text in ODD if text != "same text")
    whole = [[x for _, part in sorted(pieces) for x in part] for (i, _), pieces in ids.items() if i not in (20, 21)]
    assert sorted(map(str, whole)) == texts


def test_pack_little_padding(spark, small):
    pieces = pack(spark.read.parquet(f"{small}/documents.parquet"))
    r = pieces.agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("k")).first()
    assert r.n / (r.k * 2048) > 0.9


def test_token_files_round_trip(odd, library, tmp_path):
    write_token_files(odd, str(tmp_path / "out"))
    rows = sorted(read_token_files(odd.sparkSession, str(tmp_path / "out")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd.collect()), key=lambda x: (x is not None, x))
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    by_text = sorted(str(plain(library, text) + [0]) for text in ODD)
    assert sorted(str(np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == by_text


def test_counts(odd, library, spark, small):
    got = sorted((r.n_bytes, r.n_tokens) for r in count_tokens(odd).collect())
    assert got == sorted((len((text or "").encode()), len(plain(library, text))) for text in ODD)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: len(plain(library, r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs).collect()} == want


def test_counts_over_small_blocks_and_sums(monkeypatch, library):
    from tidelake.llm import token_counts

    texts = [f"a b c{i % 3} a" for i in range(20)]
    sums = {}
    rows = [b for k in range(4) for b in token_counts._block(default_tokenizer(), k, __import__("pyarrow").array(range(5 * k, 5 * k + 5)), texts[5 * k : 5 * k + 5])]
    monkeypatch.setattr(token_counts, "_SUM_BYTES", 16)
    out = [x for b in token_counts._sum_postings(default_tokenizer())(iter(rows)) for x in b.to_pylist()]
    for row in sorted(out, key=lambda x: x["block"]):
        sums.setdefault(row["block"], []).append(row)
    for k, parts in sums.items():
        named = token_counts._named(parts).to_pylist()
        assert [x["n_tokens"] for x in named] == [len(plain(library, t)) for t in texts[5 * k : 5 * k + 5]]


def test_counts_of_a_blank_block(spark):
    rows = [(1, ""), (2, None), (3, " ")]
    assert sorted(map(tuple, count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect())) == [(1, 0, 0), (2, 0, 0), (3, 1, 1)]


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack(none).count() == count_tokens(none).count() == 0
    write_token_files(none, str(tmp_path / "none"))
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_query_digests(spark, small, library):
    from tidelake.llm.queries import op6_token_files

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in op6_token_files(spark, small).collect():
        ids = np.array([*plain(library, texts[r.doc_id]), 0], "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r.n_tokens, r.ids_crc32)


def test_counts_of_nul_characters(spark, library):
    texts = ["a \0\0b", "\0\0", " \0\0 \0\x001 x", "plain words", "\0\x000 \0\x000"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for rows in (frame.coalesce(1), frame.repartition(3)):
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(rows).collect()} == {i: (len(t), len(plain(library, t))) for i, t in enumerate(texts)}


def test_unknown_units_go_to_the_library_strung_together():
    from tidelake.llm.tokens import Encoder

    class Counted:
        def __init__(self, library):
            self.library, self.texts = library, 0

        def __getattr__(self, name):
            return getattr(self.library, name)

        def encode_batch_fast(self, texts, **more):
            self.texts += len(texts)
            return self.library.encode_batch_fast(texts, **more)

    made = Encoder(default_tokenizer())
    library = made.library
    made.library, made.words = Counted(library), Counted(made.words)
    texts = ["\n".join(" ".join(f"wo{'abcdefgh'[k % 8]}rd{'xyzéñ'[i % 5] * (k % 7 + 1)}{['', '.', '$$$', '12'][i % 4]}" for k in range(40)) for i in range(20)) for _ in range(3)]
    texts += ["a\n", "\nb", "x \n y", "a\r\nb", " the <|endoftext|> end", "it's 's it'll", "1\xa0 \xa02", "", "\n", "tab\tbed $$$$$ '"]
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert list(made.encode(texts)) == want
    units = {u for t in texts for u in made.units(t)}
    assert len(units) > 300 and made.library.texts + made.words.texts < len(units) / 3
