"""Registered queries ``opN_<name>`` of the training-data operators, with
DuckDB statements where SQL can say the same.  Every query reads its whole
table; the operator does the work and the query picks the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


#: Quality weights of the mix by ``labels.quality`` (fixed values of these queries).
QUALITY = {1: 2.0, 0: 0.5}


def quality_weights(labels: DataFrame) -> DataFrame:
    """One row per labelled document: doc_id and its best label's weight."""
    best = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("__label"))
    weight = F.coalesce(*[F.when(F.col("__label") == k, F.lit(v)) for k, v in QUALITY.items()], F.lit(1.0))
    return best.select("doc_id", weight.alias("__quality"))


def text_tie(text):
    """Orders rows that share an id: a digest of the text."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


_OP1_SQL = r"""
WITH lab AS (SELECT doc_id, max(quality) q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    CASE lab.q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS w,
    md5(coalesce(text, '')) AS tie,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents LEFT JOIN lab USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3
                   WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS sw,
         source_size::DOUBLE * 2.0::DOUBLE AS cap FROM s),
s2 AS (SELECT *, cap / sw AS filled, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM s1),
s3 AS (SELECT *, row_number() OVER f AS rk,
         (budget - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(sw) OVER () - coalesce(sum(sw) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
       FROM s2 WINDOW f AS (ORDER BY filled, source NULLS LAST)),
s4 AS (SELECT *, min(CASE WHEN lev <= filled THEN rk END) OVER () AS first_open FROM s3),
s5 AS (SELECT *, CASE WHEN first_open IS NOT NULL AND rk >= first_open
                   THEN max(CASE WHEN rk = first_open THEN lev END) OVER () * sw ELSE cap END AS target FROM s4),
s6 AS (SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM s5),
r AS (SELECT d.*, s6.source_size, s6.target, s6.epochs,
        sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / w, doc_id, size, tie
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start_at
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN start_at + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op1_mix_sources", _OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source weight; quality from ``labels`` (1: 2.0, 0: 0.5, none: 1.0)."""
    from .mixing import mix_to_targets

    docs = C.table(spark, sf_dir, "documents").select(
        "doc_id", "source", C.word_count(F.col("text")).alias("__words"), text_tie(F.col("text")).alias("__digest"))
    docs = C.materialise(docs.join(quality_weights(C.table(spark, sf_dir, "labels")), "doc_id", "left"), "mix-docs")
    mixed = mix_to_targets(docs, F.col("__words"), F.coalesce("__quality", F.lit(1.0)), tie=F.col("__digest"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: (verdict, host, path); fixed values of the contract.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_OP6_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(v, h, q) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                          ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, arg_max(h || q, length(h || q)) AS rule, arg_max(v, length(h || q)) AS verdict
      FROM (SELECT DISTINCT page_id, host, path FROM p) JOIN rules
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""


@query("op6_url_cascade", _OP6_SQL)
def op6_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules; a page that meets none is allowed."""
    from .cascade import judge_urls

    return judge_urls(C.table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query("op7_ring_shards")
def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 24 shards, loads bounded to equal counts."""
    from .ring import shard_documents

    return shard_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    from .langid import learn, predict

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", C.held_out(F.col("doc_id")))
    return predict(docs, learn(docs.where("not held_out")), F.col("text"), ["doc_id", "held_out"])


def toxicity_model(spark: SparkSession, sf_dir: str):
    """Classifier learned from the labelled documents that are not held out."""
    from .toxicity import learn

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text").where(~C.held_out(F.col("doc_id")))
    labels = C.table(spark, sf_dir, "labels").select("doc_id", "toxic").distinct()
    return learn(docs.join(labels, "doc_id"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled rows that are not held out."""
    from .toxicity import score

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", C.held_out(F.col("doc_id")).alias("held_out"))
    return score(docs, toxicity_model(spark, sf_dir), F.col("text"), ["doc_id", "held_out"])


@query("op5_setsketch_near_dups")
def op5_setsketch_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a similarity of 0.8 or more."""
    from .setsketch import near_duplicates

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_duplicates(docs, F.col("text"), shingle=4, threshold=0.8)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that 20-word windows repeat from earlier text, removed."""
    from .substring import remove_repeats

    out = remove_repeats(C.table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_OP9_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op9_exact_top_k", _OP9_SQL)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector with all other vectors."""
    from .topk import top_k

    rows = C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, F.col("vec_id") % 50 == 0, k=5)


_OP10_SQL = r"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS size, least(len(w), 5) AS g FROM iw WHERE len(w) > 0),
ig AS (SELECT item_id, size, g, size - g + 1 AS n_all, unnest(list_transform(range(1, size - g + 2), lambda p: array_to_string(w[p:p + g - 1], ' '))) AS h FROM i),
ic AS (SELECT item_id, size, g, n_all, h, count(*) AS c FROM ig GROUP BY ALL),
sizes AS (SELECT DISTINCT g FROM i),
dg AS (SELECT doc_id, len(w) AS n, g, unnest(range(0, greatest(len(w) - g + 1, 1))) AS pos,
              unnest(list_transform(range(1, greatest(len(w) - g + 1, 1) + 1), lambda p: array_to_string(w[p:p + g - 1], ' '))) AS h
       FROM dw, sizes WHERE len(w) > 0),
s AS (SELECT DISTINCT dg.doc_id, dg.n, ic.item_id, ic.size, ic.g, ic.n_all, greatest(least(dg.pos, dg.n - ic.size), 0) AS st
      FROM dg JOIN ic USING (h, g)),
win AS (SELECT s.doc_id, s.item_id, s.st, s.n_all, s.g, dg.h, count(*) AS c, greatest(least(s.size, s.n) - s.g + 1, 1) AS w_all
        FROM s JOIN dg ON dg.doc_id = s.doc_id AND dg.g = s.g AND dg.pos BETWEEN s.st AND s.st + s.size - s.g
        GROUP BY ALL),
sh AS (SELECT win.doc_id, win.item_id, win.st, win.n_all, win.w_all, sum(least(win.c, ic.c)) AS both_n
       FROM win JOIN ic USING (item_id, h) GROUP BY ALL),
ok AS (SELECT *, both_n / (n_all + w_all - both_n) AS sim FROM sh WHERE both_n * 100 >= (n_all + w_all - both_n) * 80)
SELECT doc_id, item_id, max(sim)::DOUBLE AS similarity, arg_max(st, (sim, st))::BIGINT AS start_word FROM ok GROUP BY doc_id, item_id
"""


@query("op10_simhash_decontaminate", _OP10_SQL)
def op10_simhash_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose item-sized window is 0.8 similar or more."""
    from .decontam import find_leaks

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, C.table(spark, sf_dir, "benchmark").select("item_id", "text"))


#: Conversation -7 of the contract: (turn, role); both say the same.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


@query("op4_prefix_tree_chat")
def op4_prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (and -7) as a prefix tree, read back from its nodes."""
    from .chat import format_tree, read_back

    rows = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA_TEXT), (-7, 1, "assistant", EXTRA_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(*format_tree(rows.unionByName(extra)))


@query("op13_lattice_score")
def op13_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from nine tenths of them."""
    from .lmscore import score_texts

    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held = F.coalesce(F.pmod(crc, F.lit(10)) == 0, F.lit(True))
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    return score_texts(docs, F.col("text"), ~F.col("held_out"), ["doc_id", "held_out"])


_OP11_SQL = r"""
WITH lab AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
             FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * len(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < coalesce(doc_id, 9223372036854775807), false)::INT AS mask
      FROM d LEFT JOIN lab USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM l a, l b, l c, l d, l e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, i::INT AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS before
      FROM o, range(1, 6) r(i)),
p AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM p
"""


@query("op11_filter_audit", _OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors, removals, redundancies, label losses and Shapley sums of five
    text filters in all 120 orders, by source."""
    from .audit import audit_texts

    return audit_texts(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


@query("op12_feast_whitening")
def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 components of the largest variance, whitened."""
    from .whiten import whiten

    return whiten(C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
