"""The operators applied to the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    binary_records, centroid_clusters, decontaminate, divergence_rules, line_crf, packing, reply_trees, secret_scan, simhash,
    spelling, token_counts, toxicity, url_filter,
)
from snapmart.llm.common import stage

#: File names of the public vocabularies.
COUNT_VOCABULARY, PACK_TOKENIZER, RECORD_TOKENIZER = "byte_bpe_50k.tiktoken", "word_bpe_49k.json", "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, pre-tokens and bytes of every document."""
    import public_tokenizers

    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_VOCABULARY), public_tokenizers.PATTERN)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along the Hilbert curve into sequences of 4096 tokens."""
    import public_tokenizers

    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "hilbert_key")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the patterns' spans, and all spans."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind"].isin([p.kind for p in secret_scan.PATTERNS]))
    return found.select("doc_id", "secret_spans", base.alias("base")).select(
        "doc_id",
        *[_count(F.col("base"), p.kind).alias(f"n_{p.kind}") for p in secret_scan.PATTERNS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item, within the item's error budget."""
    return decontaminate.find_copies(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and the verdict by distance to the language references."""
    judged = divergence_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "language", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learnt from labels outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_crf.train(docs, _table(spark, sf_dir, "labels"))
    scored = line_crf.score(docs, field)
    return scored.select(
        "doc_id", F.coalesce(~line_crf.learnable("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= line_crf.GOOD).cast("int").alias("predicted"), "n_lines", "n_bad_lines")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures. The table has no fetch time, so each page gets one day of a year by its id."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")
    return _table(spark, sf_dir, "pages").select(
        "page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched_at"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list over the pages' own hosts, domains, directories of every depth and URLs.

    The given tables hold no list, so days and actions come from a hash of the
    pattern and the number of the entry; about one URL in eight is listed by itself.
    """
    url = F.col("url")
    host, key = url_filter.host_of(url), url_filter.url_key(url)

    def named(kind: str, patterns: Column, entries: int) -> Column:
        return F.transform(patterns, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"), F.lit(entries).alias("entries")))

    patterns = _table(spark, sf_dir, "pages").where(host != "").select(F.explode(F.concat(
        named("domain", F.slice(F.reverse(url_filter.domains_of(host)), 1, 1), 2), named("host", F.array(host), 4),
        named("prefix", url_filter.prefixes_of(url), 2),
        named("url", F.filter(F.array(key), lambda k: F.substring(F.md5(k), 1, 1).isin("0", "1")), 3),
    )).alias("p")).select("p.*").distinct()
    digest = F.md5(F.concat_ws(":", F.col("kind"), F.col("pattern"), F.col("entry").cast("string")))
    number = lambda at, size: F.conv(F.substring(digest, at, size), 16, 10).cast("int")
    return patterns.select("kind", "pattern", F.explode(F.sequence(F.lit(1), F.col("entries"))).alias("entry")).select(
        "kind", "pattern",
        F.element_at(F.array(*map(F.lit, ("block", "block", "allow", "remove"))), number(5, 2) % 4 + 1).alias("action"),
        F.date_add(F.lit("2024-01-01").cast("date"), number(1, 4) % 365).alias("listed_at"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture against the list entries in force on its day."""
    return url_filter.judge(captures(spark, sf_dir), list_entries(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learnt from labels outside the held-out fifth."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon)
    return scored.select(
        "doc_id", F.coalesce(~toxicity.learnable("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as the best branch of its tree, formatted; the digests are read back from the output."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], given.schema)
    formatted = reply_trees.format_trees(stage(reply_trees.chains(given.unionByName(extra)), "turns"))
    back = F.pandas_udf(_read_back, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    return formatted.select(
        F.col("tree").alias("conv_id"), F.length("formatted").cast("long").alias("formatted_chars"),
        back("formatted", "loss_spans").alias("b"),
    ).select("conv_id", "b.n_turns", "b.turns_sha256", "b.loss_chars", "b.loss_sha256", "formatted_chars")


def _read_back(formatted: pd.Series, loss_spans: pd.Series) -> pd.DataFrame:
    import hashlib

    rows = []
    for whole, spans in zip(formatted, loss_spans):
        turns = reply_trees.parse(whole)
        learnt = "".join(reply_trees.unescape(whole[s["start"] : s["stop"]]) for s in (() if spans is None else spans))
        rows.append((
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learnt), hashlib.sha256(learnt.encode()).hexdigest(),
        ))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds from 40 of them, with the distances' sums."""
    placed = centroid_clusters.cluster(_table(spark, sf_dir, "embeddings"))
    return placed.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256).alias("centroid_sha256"))


def op12_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as binary records in order of doc_id and read back."""
    import public_tokenizers

    files = binary_records.write_records(_table(spark, sf_dir, "documents"), public_tokenizers.path(RECORD_TOKENIZER))
    return binary_records.read_records(files).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, each with its near words, its form and its root."""
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_packing, op3_secret_scan, op4_decontamination, op5_divergence_rules, op6_line_crf,
        op7_url_filter, op8_toxicity, op9_simhash, op10_reply_trees, op11_centroid_clusters, op12_binary_records,
        op13_spelling_variants)
}

_HOST = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)', 1))"
_PATH = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1)"
_KEY = f"{_HOST} || {_PATH} || regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1)"
_DIRS = f"list_filter(string_split(regexp_extract({_PATH}, '^(.*)/', 1), '/'), lambda d: d <> '')"


def _dated(kind: str, patterns: str, entries: int) -> str:
    digest = f"md5('{kind}:' || pattern || ':' || entry)"
    return f"""
    SELECT '{kind}' AS kind, pattern,
      (['block', 'block', 'allow', 'remove'])[CAST('0x' || substr({digest}, 5, 2) AS INTEGER) % 4 + 1] AS action,
      DATE '2024-01-01' + (CAST('0x' || substr({digest}, 1, 4) AS INTEGER) % 365) AS day
    FROM (SELECT DISTINCT pattern FROM ({patterns})), (SELECT unnest(range(1, {entries} + 1)) AS entry)"""


def _clusters(k: int = 40, rounds: int = 5, size: int = 64, seed: int = 2) -> str:
    """The rounds as one common table expression after the other: vectors and centroids as rows of (number, place, component)."""
    parts = [f"""
kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
vectors AS (SELECT vec_id, unnest(range({size})) AS place, unnest(v) AS x FROM kept),
c0 AS (
  SELECT nth AS cluster, unnest(range({size})) AS place, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS nth FROM kept) WHERE nth < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS (
  SELECT vec_id, cluster, distance FROM (
    SELECT vec_id, cluster, distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS nth FROM (
      SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM vectors v JOIN c{i} c USING (place) GROUP BY vec_id, cluster))
  WHERE nth = 1)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN vectors USING (vec_id) GROUP BY cluster, place),
c{i + 1} AS (
  SELECT cluster, place, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{i} LEFT JOIN m{i} USING (cluster, place))""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
  USING (cluster)"""


ORACLE: dict[str, str] = {
    "op11_centroid_clusters": _clusters(),
    "op7_url_filter": f"""
WITH entries AS ({" UNION ALL ".join((
        _dated("domain", f"SELECT array_to_string((string_split({_HOST}, '.'))[-2:], '.') AS pattern FROM pages WHERE {_HOST} LIKE '%.%'", 2),
        _dated("host", f"SELECT {_HOST} AS pattern FROM pages WHERE {_HOST} <> ''", 4),
        _dated("prefix", f"SELECT {_HOST} || '/' || array_to_string(({_DIRS})[:i], '/') || '/' AS pattern "
               f"FROM (SELECT url, unnest(range(1, len({_DIRS}) + 1)) AS i FROM pages WHERE {_HOST} <> '')", 2),
        _dated("url", f"SELECT pattern FROM (SELECT {_KEY} AS pattern FROM pages WHERE {_HOST} <> '') WHERE substr(md5(pattern), 1, 1) IN ('0', '1')", 3),
    ))}),
daily AS (
  SELECT kind, pattern, day, min(CASE action WHEN 'block' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS rank
  FROM entries GROUP BY kind, pattern, day),
valid AS (
  SELECT kind, pattern, rank, day AS valid_from, lead(day) OVER (PARTITION BY kind, pattern ORDER BY day) AS valid_to FROM daily),
captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 365 AS INTEGER) AS fetched_on,
    {_HOST} AS host, {_KEY} AS key, {_DIRS} AS dirs FROM pages),
named AS (
  SELECT page_id, 'url' AS kind, key AS pattern FROM captures WHERE host <> ''
  UNION ALL SELECT page_id, 'host', host FROM captures WHERE host <> ''
  UNION ALL SELECT page_id, 'prefix', host || '/' || array_to_string(dirs[:i], '/') || '/'
    FROM (SELECT *, unnest(range(1, len(dirs) + 1)) AS i FROM captures WHERE host <> '')
  UNION ALL SELECT page_id, 'domain', array_to_string(string_split(host, '.')[i:], '.')
    FROM (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS i FROM captures)),
met AS (
  SELECT c.page_id, n.kind, n.pattern, v.rank, v.valid_from, row_number() OVER (
      PARTITION BY c.page_id ORDER BY CASE n.kind WHEN 'url' THEN 3 WHEN 'prefix' THEN 2 WHEN 'host' THEN 1 ELSE 0 END DESC,
      length(n.pattern) DESC) AS nth
  FROM captures c JOIN named n USING (page_id) JOIN valid v ON v.kind = n.kind AND v.pattern = n.pattern
    AND c.fetched_on >= v.valid_from AND (v.valid_to IS NULL OR c.fetched_on < v.valid_to)
  WHERE v.rank < 2)
SELECT c.page_id, c.url, c.fetched_on, coalesce(m.rank = 0, false) AS blocked, m.kind, m.pattern, m.valid_from AS listed_on
FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.nth = 1""",
    "op10_reply_trees": r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given WHERE conv_id IS NOT NULL)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 24) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
}
