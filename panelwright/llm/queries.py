"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_pack_documents")
def pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    from panelwright.llm.packing import pack_documents as run
    from panelwright.llm.tokens import default_vocabulary

    placed = run(table(spark, sf_dir, "documents"), default_vocabulary(), capacity=4096, end_id=2)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_token_store")
def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document read back from the compressed token files."""
    from panelwright.llm.token_store import read_shards, store_documents
    from panelwright.llm.tokens import default_vocabulary

    return read_shards(*store_documents(table(spark, sf_dir, "documents"), default_vocabulary(), end_id=1))


@query("op5_mix_sources")
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from panelwright.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


_REPETITION = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
lines AS (SELECT doc_id, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM w),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
g AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT * FROM (SELECT doc_id, i, g, count(*) OVER (PARTITION BY doc_id, g) AS k FROM g WHERE g IS NOT NULL) WHERE k > 1),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, range(5) x(o) GROUP BY doc_id),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS d FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i),
runs AS (SELECT doc_id, d, count(*) + 4 AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS run FROM pairs)
         GROUP BY doc_id, d, run),
l AS (SELECT doc_id, max(n) AS n FROM runs GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(l.n, 0) AS BIGINT) AS longest_repeat
  FROM w JOIN lines USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND longest_repeat <= 100 AS kept FROM m"""


@query("op6_repetition_rules", _REPETITION)
def repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts, repetition and verdict of every document."""
    from panelwright.llm.repetition import repetition

    return repetition(table(spark, sf_dir, "documents"))


@query("op4_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    ``n_near`` says for every document whose id is divisible by 100 how many documents have a fingerprint within three
    bits of its own, itself included.
    """
    from pyspark.sql import functions as F

    from panelwright.llm.simhash import fingerprint_documents, likeness, near_counts
    from panelwright.storage import materialize

    marked = materialize(fingerprint_documents(table(spark, sf_dir, "documents")), "marked")
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    joined = marked.join(near_counts(marked, asked), "fingerprint", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_fingerprint")), 16, "0").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
    )


@query("op9_secret_spans")
def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, sure ones and linked weak ones."""
    from panelwright.llm.credentials import digests, find_secrets

    return digests(find_secrets(table(spark, sf_dir, "documents")))


@query("op8_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, sure forms and what the trees add."""
    from panelwright.llm.pii import digests, find_personal

    return digests(find_personal(table(spark, sf_dir, "documents")))


_SHINGLES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""


@query("op7_jaccard_components", _SHINGLES)
def jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    from panelwright.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_repeated_passages")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of every document that an earlier one holds as well."""
    from panelwright.llm.chunks import repeated_passages as run

    return run(table(spark, sf_dir, "documents"))


@query("op3_page_text")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from panelwright.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


_TRIE = r"""
WITH t AS (
  SELECT conv_id AS c, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(x ORDER BY i) AS xs FROM t GROUP BY c),
h AS (
  SELECT c, xs, xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda a, b: list_reduce([CAST(k AS BIGINT) FOR k IN range(8)],
             lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(a, b)), CAST(4294967295 AS BIGINT))) % 9 AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(b.xs[1:h.h], []), h.xs[h.h + 1:]) AS xs FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5),
m AS (SELECT c, xs, d, xs[1:d] AS p FROM (SELECT c, xs, unnest(range(len(xs) + 1)) AS d FROM r)),
n AS (
  SELECT p, d, min(c) AS c, count(*) AS n, coalesce(strlen(p[d].text), 0) AS b, count(*) FILTER (len(xs) > d) AS onward,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(xs) = d), '')) AS ends FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
s AS (SELECT n.p[1:u.a] AS p, count(*) FILTER (n.onward = 0) AS leaves, sum((n.n - 1) * n.b) AS saved
      FROM n, LATERAL (SELECT unnest(range(n.d + 1)) AS a) u GROUP BY 1)
SELECT n.c AS conv_id, n.d AS depth, q.c AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n LEFT JOIN n q ON n.d > 0 AND q.d = n.d - 1 AND q.p = n.p[1:n.d - 1] LEFT JOIN k ON k.p = n.p JOIN s ON s.p = n.p"""


@query("op11_prefix_trie", _TRIE)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    from panelwright.llm.prefix_trie import prefix_trie as run

    return run(table(spark, sf_dir, "conversations")).drop("node", "parent")


@query("op12_balanced_shards")
def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, with equal texts together and shards of equal bytes."""
    from panelwright.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=8, law="bytes")


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two vocabularies cut every document, and how common its linked ids are."""
    from panelwright.llm.alignment import align_documents

    return align_documents(table(spark, sf_dir, "documents"))
