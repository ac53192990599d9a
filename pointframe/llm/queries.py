"""The registered queries of the operators: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointframe.llm.chat import format_chats, loss_text, read_turns
from pointframe.llm.common import ascii_lower, words
from pointframe.llm.decontaminate import find_overlaps
from pointframe.llm.exact_dedup import exact_dedup
from pointframe.llm.jaccard_join import near_duplicates
from pointframe.llm.license_scan import NOTICES, PHRASES, scan_licenses, stride, text_words
from pointframe.llm.line_dedup import line_report
from pointframe.llm.merkle import fold, leaf_digest, prove, siblings
from pointframe.llm.mixing import mix
from pointframe.llm.periodic_runs import find_runs
from pointframe.llm.secrets import join_spans, scan_secrets
from pointframe.llm.toxicity import score_toxicity
from pointframe.llm.url_filter import judge_urls
from pointframe.llm.warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_chats(turns, content="text").withColumn("turns", read_turns(F.col("formatted")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


# the rules of the registered query: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), RULES).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "shard")


def _not_held_out(id: str = "id"):
    """The fold of an id: labels are learned only where this holds."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 3 != 1


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), learn=_not_held_out())
    return scored.select(F.col("id").alias("doc_id"), (~_not_held_out()).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(kind).cast("long").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"), join_spans(F.col("spans")).alias("spans"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_warc(_table(spark, sf_dir, "pages"))
    return read_warc(spark, files).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def _rewritten(docs: DataFrame) -> DataFrame:
    """The query's texts: for a tenth of the ids the words from a place on repeat with a period, both drawn from the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10).cast("long"))
    w = words("text")
    n = F.size("w").cast("long")
    cut = known.withColumn("w", F.when(F.col("h") % 10 == 0, w)).withColumn("a", F.when(n > 0, F.col("g") % n))
    cut = cut.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return cut.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_rewritten(_table(spark, sf_dir, "documents")), min_length=24, min_exponent=3)

    def stronger(best, r):  # by exact length / period; runs come by start, then period, so the first of equals stays
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = found.withColumn("best", F.aggregate("runs", none, stronger))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    whole, other = (leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text) for text in (F.col("text"), ascii_lower("text")))
    leaves = docs.select("doc_id", "lang", whole.alias("leaf"), F.when(tampered, other).otherwise(whole).alias("shown"))
    proved = prove(leaves, order="doc_id", group="lang", leaf="leaf", carry=("shown",))
    found = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                          fold(F.col("shown"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    starts = F.col("places")["start"]
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def _license_sql() -> str:
    """Every block of every text against every notice, by counting common words."""
    def listed(ws):
        return "[" + ", ".join(f"'{w}'" for w in ws) + "]"

    phrases = ", ".join(f"({listed(text_words(p))}, '{label}')" for p, label in PHRASES)
    notices = ", ".join(f"({listed(sorted(set(text_words(t))))}, '{label}')" for label, t in NOTICES)
    size = stride(NOTICES)
    return rf"""
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p(ws, label) AS (VALUES {phrases}),
        b AS (SELECT r, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(ws)] = ws)) AS i FROM t, p),
        base AS (SELECT r, count(*) AS n, min(i) AS first, max(i) AS last, list(label) AS labels FROM b GROUP BY r),
        k AS (SELECT r, w, unnest(range(0, greatest(1, (len(w) + {size - 1}) // {size} - 1))) AS block FROM t),
        h AS (SELECT r, list_distinct(w[block * {size} + 1:(block + 2) * {size}]) AS held FROM k),
        m(ws, label) AS (VALUES {notices}),
        f AS (SELECT r, label, len(list_intersect(held, ws)) AS i, len(ws) AS n FROM h, m WHERE i * 100 >= n * 90),
        own AS (SELECT r, max(i / n) AS score, list(label) AS labels FROM f GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, first::BIGINT AS first_word, last::BIGINT AS last_word,
               array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(own.labels, []))), ',') AS labels,
               CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(own.score, 0.0) END::DOUBLE AS score
        FROM t LEFT JOIN base USING (r) LEFT JOIN own USING (r)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_chat, op3_url_filter, op4_mixing, op5_toxicity, op6_line_dedup, op7_secrets, op8_warc, op9_jaccard, op10_exact_dedup,
                             op11_periodic_runs, op12_merkle, op13_license)}

ORACLE: dict[str, str] = {
    "op2_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(23 + length(regexp_replace(role || text, '([<\[\\])', '\1\1', 'g')))::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    # the CRC-32 of the id's digits runs over a list of its bytes, each followed by eight -1 for the bits
    "op12_merkle": r"""
        WITH RECURSIVE t AS (
            SELECT *, list_reduce(flatten([[4294967295::BIGINT]] || list_transform(range(1, length(doc_id::VARCHAR) + 1),
                       lambda k: [unicode(substr(doc_id::VARCHAR, k, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM documents),
        h AS (
            SELECT doc_id, lang, xor(crc, 4294967295) % 3 = 0 AS bad, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS low
            FROM (SELECT *, coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
                         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM t)),
        l AS (SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
              FROM h WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
        v(k, g, i, n, d) AS (
            SELECT 0, g, i, n, leaf FROM l
            UNION ALL SELECT k + 1, g, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM v WHERE n > 1 GROUP BY k, g, i // 8, n),
        s AS (SELECT g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM v WHERE n = 1),
        u(k, i, n, d) AS (
            SELECT 0, i, n, d FROM s
            UNION ALL SELECT k + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY k, i // 8, n),
        a AS (SELECT g, k, i, n, d FROM v UNION ALL SELECT NULL, k, i, n, d FROM u),
        b AS (SELECT g, k, i, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS x,
                     coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS y
              FROM a WHERE n > 1 WINDOW w AS (PARTITION BY g, k, i // 8 ORDER BY i)),
        p AS (SELECT l.g, l.i, list(x || '?' || y ORDER BY k) AS steps FROM l JOIN b ON b.g = l.g AND b.i = l.i // (8 ** k)::BIGINT GROUP BY ALL),
        q AS (SELECT s.g, list(x || '?' || y ORDER BY k) AS steps FROM s JOIN b ON b.g IS NULL AND b.i = s.i // (8 ** k)::BIGINT GROUP BY ALL),
        f AS (SELECT l.doc_id, l.leaf, CASE WHEN l.bad THEN l.low ELSE l.leaf END AS shown, s.d AS subroot, (SELECT d FROM u WHERE n = 1) AS root,
                     coalesce(p.steps, []::VARCHAR[]) || coalesce(q.steps, []::VARCHAR[]) AS steps
              FROM l JOIN s ON s.g = l.g LEFT JOIN p ON p.g = l.g AND p.i = l.i LEFT JOIN q ON q.g = l.g)
        SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '?', '')) AS proof_sha256,
               list_reduce([shown] || steps, lambda d, z: sha256(replace(z, '?', d))) AS folded_root, folded_root = root AS verified
        FROM f""",
    "op13_license": _license_sql(),
    "op8_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, html, octet_length(encode(html)) AS payload_bytes, upper(sha1(html)) AS hex,
                     min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, payload_bytes,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                      ((('0x' || substr(hex, 5 * (c // 4) + 1, 5))::INT >> (15 - 5 * (c % 4))) & 31) + 1, 1)
                               for c in range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM d""",
    "op9_jaccard": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                              ELSE [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] END) AS g FROM t),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(v, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v)
        SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(root) AS component_id FROM r GROUP BY v) c USING (doc_id)""",
}
