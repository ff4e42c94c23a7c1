"""The registered queries of this package, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    attribution, chat, decontaminate, divergence, licenses, middle, neighbours, packing, quality, sharding, shards,
    simhash, tokens, wrappers,
)
from .common import importable, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids."""
    pieces = packing.pack(docs, tokens.default_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op10_concatenate_and_cut")
def concatenate_and_cut(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


SHARDS_SQL = f"""
WITH h AS (SELECT doc_id, coalesce(strlen(text), 0) AS b, ('0x' || substr(md5(cast(doc_id AS VARCHAR)), 1, 8))::BIGINT AS h FROM documents),
l AS (SELECT doc_id, b, d, h >> (32 - d) AS p FROM h, (SELECT unnest(range(0, 33)) AS d)),
s AS (SELECT d, p, sum(b)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY d, p),
f AS (SELECT l.*, shard_bytes, shard_docs, row_number() OVER (PARTITION BY doc_id ORDER BY d) AS r
      FROM l JOIN s USING (d, p) WHERE shard_bytes <= {sharding.MAX_BYTES} OR shard_docs = 1)
SELECT doc_id, b::BIGINT AS n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d::INTEGER, '0') END AS shard,
    d::INTEGER AS depth, shard_bytes, shard_docs FROM f WHERE r = 1"""


@query("op1_extendible_hashing", SHARDS_SQL)
def extendible_hashing(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"), carry=False)


@query("op3_multiprobe_hashing")
def multiprobe_hashing(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0"))


# Independent of the masks: 13 places with 2 substitutions always keep a run of four words;
# shorter items are tried wherever a single word agrees.
OVERLAPS_SQL = r"""
WITH dt AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM (SELECT doc_id,
    list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents)),
it AS (SELECT item_id, unnest(w) AS t, generate_subscripts(w, 1) AS p, len(w) AS n FROM (SELECT item_id,
    list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) >= 5),
dg AS (SELECT doc_id, p, t || ' ' || lead(t, 1) OVER o || ' ' || lead(t, 2) OVER o || ' ' || lead(t, 3) OVER o AS g
       FROM dt WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
ig AS (SELECT item_id, p, t || ' ' || lead(t, 1) OVER o || ' ' || lead(t, 2) OVER o || ' ' || lead(t, 3) OVER o AS g
       FROM it WINDOW o AS (PARTITION BY item_id ORDER BY p)),
c AS (SELECT doc_id, item_id, dg.p - ig.p AS d FROM dg JOIN ig USING (g)
    UNION SELECT doc_id, item_id, dt.p - it.p FROM dt JOIN it USING (t) WHERE it.n < 13),
few AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
tiny AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
m AS (SELECT c.doc_id, c.item_id, c.d, it.p, it.n, CASE WHEN dt.t IS NULL THEN 0 ELSE 1 END AS same
      FROM c JOIN it USING (item_id) LEFT JOIN dt ON dt.doc_id = c.doc_id AND dt.p = it.p + c.d AND dt.t = it.t),
s AS (SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, d ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k FROM m)
SELECT doc_id, item_id, max(k)::INTEGER AS matched, count(*) AS windows, min(p + d - 1)::BIGINT AS first_word
FROM s WHERE p <= greatest(n - 12, 1) AND k >= (4 * least(n, 13) + 4) // 5 GROUP BY doc_id, item_id
UNION ALL SELECT doc_id, item_id, any_value(len(w))::INTEGER, count(*), 0::BIGINT FROM few JOIN tiny USING (w) WHERE len(w) BETWEEN 1 AND 4 GROUP BY doc_id, item_id"""


@query("op2_spaced_seeds", OVERLAPS_SQL)
def spaced_seeds(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"
CHATS_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(replace(text, '\\', '\\\\')) + len(regexp_extract_all(text, '[<\\[](/?s>|<?/?SYS>>|/?INST\\]|/?TURN\\]|TEXT\\])'))
        + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 19 + length(role) END)::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""


@query("op4_event_sourced_chat", CHATS_SQL)
def event_sourced_chat(spark, sf_dir):
    """Digests of what is read back from the formatted conversations."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    events = rows.unionByName(probe).select(
        "conv_id", F.col("turn").alias("seq"), F.lit(None).cast("string").alias("message_id"),
        F.lit("message").alias("kind"), "role", "text",
    )
    out = chat.format_chats(events)
    out = out.withColumn("read", chat.read_back(F.col("formatted")))
    turns = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    out = out.withColumns({"turns": F.array_join(turns, ""), "n_read": F.size("read").cast("long"), "loss": chat.masked_text(F.col("formatted"), F.col("loss_mask"))})
    return out.select(
        "conv_id", F.col("n_read").alias("n_turns"), F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op5_offset_attribution")
def offset_attribution(spark, sf_dir):
    """Tokens of source, language, first line and the other lines of every document."""
    docs = table(spark, sf_dir, "documents")
    line_end = F.when(F.instr("text", "\n") > 0, F.instr("text", "\n")).otherwise(F.length("text"))
    fields = {
        "source": F.concat("source", F.lit(" ")), "lang": F.concat("lang", F.lit(" ")),
        "first_line": F.substring("text", F.lit(1), line_end), "rest": F.substring("text", line_end + 1, F.length("text")),
    }
    text, sections = attribution.fields_as_sections(fields, separator="")
    return attribution.attribute(docs, text, sections, tokens.default_path())


ORDER_KEY = 20_240_229


@query("op6_simhash_vantage_points")
def simhash_vantage_points(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op7_factorisation_machine")
def factorisation_machine(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op8_signature_rules")
def signature_rules(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_training_order")
def training_order(spark, sf_dir):
    """Every packed sequence at its slot in the files: what a read of the shards gives."""
    path = tokens.default_path()
    stream = packing.encode(table(spark, sf_dir, "documents"), path)
    total = stream.bases.agg(F.max(F.col("base") + F.col("tokens"))).first()[0] or 0
    n, directory = -(-total // 1024), shared_path(spark, "shards")
    shards.write_shards(packing.cut(stream, path), n, directory, ORDER_KEY)
    return shards.read_records(spark, directory, n, ORDER_KEY)


MIDDLE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
    ('0x' || h[17:24])::BIGINT % 100 AS plain, ('0x' || h[25:32])::BIGINT % 100 AS spm FROM t),
f AS (SELECT *, least(a, b) AS i, greatest(a, b) AS j, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR plain >= 90
    THEN 'plain' WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT *, substring(t, 1, i) AS p, substring(t, i + 1, j - i) AS m, substring(t, j + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM c"""


@query("op11_chunk_memoization", MIDDLE_SQL)
def chunk_memoization(spark, sf_dir):
    out = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
z AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, any_value(v) AS v, any_value(lang_n) AS lang_n, coalesce(any_value(s.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) d
    LEFT JOIN z USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
    1 + 1000000000::HUGEINT * (k.total + 1) // (g.lang_n + g.v) AS q FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
    AND a.source <> b.source GROUP BY ALL),
whole AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM whole)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200"""


@query("op12_count_bitmaps", DIVERGENCE_SQL)
def count_bitmaps(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_wrapper_inference")
def wrapper_inference(spark, sf_dir):
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
