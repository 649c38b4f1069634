"""The registered queries: each runs one operator over its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.llm import (
    decontamination, exact, jaccard, licenses, merkle, negatives, packing, quality, secrets, sharding, substrings,
    suffixes, urls,
)
from armlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def statements() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    return dict(_SQL)


@query
def op1_quality(spark, folder):
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_substring_dedup(spark, folder):
    out = substrings.remove_repeated_spans(table(spark, folder, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op3_decontamination(spark, folder):
    documents, hits = decontamination.find_overlaps(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.summarised(documents, hits)


@query
def op4_secret_scan(spark, folder):
    """The owner of a document is its source; a source's documents in one language are a repository."""
    documents, spans = secrets.find_secrets(
        table(spark, folder, "documents"), repository=F.concat_ws("/", "source", "lang"), wide=secrets.Wide())
    return secrets.summarised(documents, spans)


@query
def op5_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), TOKENIZER, with_ids=False)


@query
def op6_license_scan(spark, folder):
    return licenses.summarised(licenses.find_notices(table(spark, folder, "documents")))


@query
def op7_exact_dedup(spark, folder):
    return exact.mark_copies(table(spark, folder, "documents"))


@query
def op8_suffix_dedup(spark, folder):
    out = suffixes.remove_earlier_strings(table(spark, folder, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op10_jaccard_join(spark, folder):
    return jaccard.join_similar(table(spark, folder, "documents"))


@query
def op11_merkle_manifest(spark, folder):
    return merkle.verified(table(spark, folder, "documents")).drop("path")


@query
def op12_hard_negatives(spark, folder):
    """Every seventh label is wrong on purpose; every hundredth row is an anchor."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op13_sharding(spark, folder):
    return sharding.assign_shards(table(spark, folder, "documents"))


URL_RULES = [
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
]


@query
def op9_url_filter(spark, folder):
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


_AT_RULES = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
_LONGEST_FIRST = sorted(URL_RULES, key=lambda r: -len(r.name))
_SQL["op9_url_filter"] = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE {' '.join(f"WHEN {_AT_RULES.format(r.host, r.path)} THEN '{r.name}'" for r in _LONGEST_FIRST)}
    END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE {' '.join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in URL_RULES)} ELSE 'allow' END AS verdict
FROM ruled"""

_SQL["op7_exact_dedup"] = """
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), groups AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM plain JOIN groups USING (t)"""


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SQL["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (SELECT doc_id, i, n, item FROM dw JOIN iw USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
met AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items
  FROM hits GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN met USING (doc_id)"""

_SQL["op2_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS x
  FROM d, unnest(range(1, len(w) - 33)) AS t(i) WHERE len(w) >= 35
), again AS (SELECT x FROM starts GROUP BY x HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, p FROM starts JOIN again USING (x), unnest(range(i, i + 35)) AS t(p)),
each AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
  FROM each ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_SQL["op10_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS x
  FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 90 * (p.n + q.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reached.a, ways.b FROM reached JOIN ways ON ways.a = reached.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) LEFT JOIN sizes USING (doc_id)"""


# CRC-32 of a text's UTF-8 bytes: the table is the rule of the checksum, bit by bit.
_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
              "lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))")


def _crc32(text: str) -> str:
    """Unsigned CRC-32 in DuckDB of a text column, with ``crc_table.steps`` at hand."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    codes = f"list_transform({pairs}, lambda h: CAST('0x' || h AS BIGINT))"
    step = "xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"


_SQL["op13_sharding"] = f"""
WITH crc_table AS MATERIALIZED (SELECT {_CRC_TABLE} AS steps),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS crc
  FROM documents, crc_table
), summed AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, crc ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
    CAST(sum(size) OVER () AS BIGINT) AS total
  FROM sized
), cut AS (SELECT *, CAST(((2 * upto - size) * 8) // (2 * total) AS INTEGER) AS shard FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""


def _tree_sql(name: str, key: str, levels: int, fanout: int = 16) -> str:
    """Levels of a Merkle tree over the table ``{name}0`` (key, place, digest), unrolled: ``{name}k`` has
    every node with its run's node above it and its siblings on both sides; one node stays as it is."""
    parts = []
    for k in range(levels):
        run = f"{key}, place // {fanout}"
        parts.append(f"""{name}_runs{k} AS (
  SELECT *, count(*) OVER (PARTITION BY {key}) > 1 AS several,
    coalesce(string_agg(digest, '') OVER (PARTITION BY {run} ORDER BY place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY {run} ORDER BY place
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k}
), {name}{k + 1} AS (
  SELECT DISTINCT {key}, CASE WHEN several THEN place // {fanout} ELSE place END AS place,
    CASE WHEN several THEN sha256(before || digest || after) ELSE digest END AS digest
  FROM {name}_runs{k}
)""")
    return ",\n".join(parts)


def _fold_sql(name: str, rows: str, key: str, levels: int, fanout: int = 16) -> str:
    """``{rows}{levels}``: the rows with proof and folded digest carried up the tree ``name``."""
    parts = []
    for k in range(levels):
        parts.append(f"""{rows}{k + 1} AS (
  SELECT r.* EXCLUDE (spot, proof, folded),
    CASE WHEN t.several THEN spot // {fanout} ELSE spot END AS spot,
    CASE WHEN t.several THEN proof || before || after ELSE proof END AS proof,
    CASE WHEN t.several THEN sha256(before || folded || after) ELSE folded END AS folded
  FROM {rows}{k} r JOIN {name}_runs{k} t ON r.{key} = t.{key} AND r.spot = t.place
)""")
    return ",\n".join(parts)


#: Enough for 16 to the power of these many rows a source, and sources.
_SOURCE_LEVELS, _TOP_LEVELS = 6, 3
_FIELDS = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    for c in ("doc_id", "source", "lang", "n_chars", "text"))
_TAMPERED = _FIELDS.replace(
    "|| text END", "|| translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END")
_SQL["op11_merkle_manifest"] = f"""
WITH crc_table AS MATERIALIZED (SELECT {_CRC_TABLE} AS steps),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS name, sha256({_FIELDS}) AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({_TAMPERED}) END AS changed
  FROM documents, crc_table
), rows0 AS (
  SELECT doc_id, name, leaf, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
    '' AS proof, coalesce(changed, leaf) AS folded
  FROM leaves
), tree0 AS (SELECT name, spot AS place, leaf AS digest FROM rows0),
{_tree_sql("tree", "name", _SOURCE_LEVELS)},
{_fold_sql("tree", "rows", "name", _SOURCE_LEVELS)},
top0 AS (
  SELECT 0 AS tree, row_number() OVER (ORDER BY name) - 1 AS place, digest, name FROM tree{_SOURCE_LEVELS}
), tops0 AS (SELECT tree, place, digest FROM top0),
{_tree_sql("tops", "tree", _TOP_LEVELS)},
up0 AS (
  SELECT doc_id, leaf, digest AS subroot, 0 AS tree, place AS spot, proof, folded
  FROM rows{_SOURCE_LEVELS} JOIN top0 USING (name)
),
{_fold_sql("tops", "up", "tree", _TOP_LEVELS)}
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = t.digest AS verified
FROM up{_TOP_LEVELS} u JOIN tops{_TOP_LEVELS} t ON u.tree = t.tree"""

_SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), near AS (
  SELECT p.anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM near WHERE rank <= 5"""
