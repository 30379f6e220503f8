"""One query per operator, over the whole table it is meant for, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import documents, stored
from tidelake.llm.decontaminate import contaminated
from tidelake.llm.language import identify
from tidelake.llm.mixing import mix
from tidelake.llm.packing import pack
from tidelake.llm.passages import near_passages
from tidelake.llm.prefix_trie import prefix_trie, turn_sequences
from tidelake.llm.quality import judge, verdict_columns
from tidelake.llm.secrets import find_secrets, listed
from tidelake.llm.sharding import shard
from tidelake.llm.simhash import fingerprints, hex_fingerprint, near_groups
from tidelake.llm.token_counts import count_tokens
from tidelake.llm.token_files import read_token_files, write_token_files
from tidelake.llm.whitening import whiten
from tidelake.session import scratch_folder


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(*verdict_columns())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > 512)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(documents(spark, sf_dir), 8)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    write_token_files(documents(spark, sf_dir), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    base = F.filter("secrets", lambda x: x["base"])

    def count(kind: str):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = identify(docs, docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(fingerprints(documents(spark, sf_dir)), "simhash-prints")
    return near_groups(prints).select("doc_id", hex_fingerprint("fingerprint").alias("fingerprint"), "component_id")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(documents(spark, sf_dir))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def spliced(sequences: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % 5; h is crc32(c) % 9."""
    none = F.filter("turns", lambda _: F.lit(False))
    taken = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    heads = sequences.where("pmod(conv_id, 5) = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    met = sequences.withColumn("base", F.expr("conv_id - pmod(conv_id, 5)")).withColumn("taken", taken).join(heads, "base", "left")
    return met.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("taken")), F.slice("turns", F.col("taken") + 1, F.size("turns"))).alias("turns"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(spliced(stored(turn_sequences(conversations), "trie-turns")))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_sharding": op5_sharding,
    "op6_token_files": op6_token_files,
    "op7_secrets": op7_secrets,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_passages": op10_passages,
    "op11_mixing": op11_mixing,
    "op12_whitening": op12_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}
# Words of a text in SQL, and A-Z lowered.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = "array_to_string(" + _WORDS.format("translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000')") + ", ' ')"

_QUALITY = f"""WITH docs AS (SELECT doc_id, source, text, {_WORDS.format("coalesce(text, '')")} AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
held AS (SELECT doc_id, source, text, unnest(lines) AS line FROM docs),
worded AS (SELECT *, len({_WORDS.format('line')}) AS n, {_NORMAL.format('line')} AS normal FROM held WHERE len({_WORDS.format('line')}) > 0),
totals AS (SELECT source, COUNT(DISTINCT text) AS total FROM documents GROUP BY ALL),
shared AS (SELECT source, normal FROM (SELECT source, normal, COUNT(DISTINCT text) AS n FROM worded GROUP BY ALL) JOIN totals USING (source) WHERE n > 10 AND n > 0.02::DOUBLE * total),
removed AS (SELECT doc_id, SUM(n)::BIGINT AS removed_words FROM worded SEMI JOIN shared USING (source, normal) GROUP BY ALL),
repeats AS (SELECT doc_id, len(line_list) - len(list_distinct(line_list)) AS n_dup_lines FROM (SELECT doc_id, list(line) AS line_list FROM worded GROUP BY ALL)),
starts AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM docs WHERE len(words) > 2),
windows AS (SELECT doc_id, i, words[i] AS a, words[i+1] AS b, words[i+2] AS c FROM starts),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS place FROM often) GROUP BY ALL),
base AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
  (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
 FROM docs LEFT JOIN repeats USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 2 * removed_words <= n_words AS kept, removed_words FROM judged"""


def _shingles(table: str, key: str) -> str:
    words = _WORDS.format(_LOWER.format("text"))
    return f"""SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM (SELECT {key}, {words} AS w FROM {table})"""


# Every item of the test tables has five words or more; shorter ones are held against loops in the tests.
_CONTAINED = f"""WITH d AS ({_shingles('documents', 'doc_id')}), b AS ({_shingles('benchmark', 'item_id')}),
sizes AS (SELECT item_id, COUNT(*) AS n FROM b GROUP BY ALL)
SELECT doc_id, item_id, k::DOUBLE / n AS containment FROM (SELECT doc_id, item_id, COUNT(*) AS k FROM d JOIN b USING (s) GROUP BY ALL) JOIN sizes USING (item_id) WHERE 10 * k >= 8 * n"""

# crc32 over a number's digits: eight shifts (-1) follow each byte.
_TAKEN = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(len(c::VARCHAR)), lambda i: [ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END), 4294967295) % 9"""

_TRIE = f"""WITH told AS (SELECT conv_id::BIGINT AS c, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(k ORDER BY turn NULLS FIRST, k, b) AS ks, list(b ORDER BY turn NULLS FIRST, k, b) AS bs FROM told GROUP BY c),
measured AS (SELECT *, ({_TAKEN})::BIGINT AS h, c - (c % 5 + 5) % 5 AS base FROM own),
rebuilt AS (SELECT m.c, list_concat(coalesce(o.ks[1:h], []), m.ks[h+1:]) AS ks, list_concat(coalesce(o.bs[1:h], []), m.bs[h+1:]) AS bs FROM measured m LEFT JOIN own o ON o.c = m.base),
steps AS (SELECT c, ks, bs, unnest(range(0, len(ks) + 1)) AS d FROM rebuilt),
nodes AS (SELECT ks[1:d] AS p, d, MIN(c) AS conv, COUNT(*) AS n, CASE WHEN d = 0 THEN 0 ELSE MIN(bs[d]) END AS b, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ks) = d), '')) AS ends FROM steps GROUP BY ks[1:d], d),
families AS (SELECT p[1:d-1] AS p, COUNT(*) AS children FROM nodes WHERE d > 0 GROUP BY p[1:d-1]),
full_nodes AS (SELECT n.*, coalesce(children, 0) AS children FROM nodes n LEFT JOIN families USING (p)),
upward AS (SELECT p, unnest(range(0, d + 1)) AS up, (n - 1) * b AS saved, (children = 0)::INT AS leaf FROM full_nodes),
below AS (SELECT p[1:up] AS p, SUM(leaf) AS leaves, SUM(saved) AS saved FROM upward GROUP BY p[1:up])
SELECT f.conv::BIGINT AS conv_id, f.d::BIGINT AS depth, up.conv::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs, f.children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN below USING (p) LEFT JOIN nodes up ON f.d > 0 AND up.p = f.p[1:f.d-1]"""

# The others need hashes, tokenizers or rounds that SQL has not; tests hold them against plain loops.
ORACLE: dict[str, str] = {"op2_quality": _QUALITY, "op3_decontamination": _CONTAINED, "op13_prefix_trie": _TRIE}
