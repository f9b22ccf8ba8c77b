"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.filter_audit import audit_filters
from tidemark.llm.html_extract import extract_main_text
from tidemark.llm.language_id import fit_network, identify_language
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.lm_score import fit_lm, score_texts
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.resharding import flow_layout

from tidemark.llm import decontaminate, secret_scan
from tidemark.llm.secret_scan import listed, scan_secrets
from tidemark.llm.substring_dedup import repeated_passages
from tidemark.llm.topk_search import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPACES_SQL = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
KEY_SQL = f"translate(trim(line, {SPACES_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_line_dedup", f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    each AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
    keyed AS (SELECT *, {KEY_SQL} AS key FROM each),
    repeated AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
    marked AS (SELECT k.*, p.key IS NOT NULL AS gone FROM keyed k LEFT JOIN repeated p ON k.key = p.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY r, doc_id""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, keep_first=False).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query("op7_ngram_join", f"""
    WITH RECURSIVE words AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
    sets AS (SELECT r, doc_id, CASE WHEN len(w) >= 4
            THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS grams FROM words),
    each AS (SELECT r, len(grams) AS n, unnest(grams) AS gram FROM sets),
    links AS (SELECT a.r AS a, b.r AS b FROM each a JOIN each b ON a.gram = b.gram AND a.r <> b.r
            GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT s.doc_id, len(s.grams) AS n_shingles, min(o.doc_id) AS component_id
    FROM reach JOIN sets s ON reach.a = s.r JOIN sets o ON reach.b = o.r GROUP BY s.r, s.doc_id, s.grams""")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, similarity=85)


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    network = fit_network(docs.where(remainder != 0).select("lang", "text"))
    predicted = identify_language(docs.select("doc_id", "text"), network)
    return predicted.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op8_mix_sources")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans_sql(kind: str, rank: int, pattern: str, kept: str = "true", group: int = 0) -> str:
    """Positions from the pieces between the matches and the matches, as in the query."""
    return f"""SELECT r, {rank} AS rank, '{kind}' AS kind, start, start + length(hit) AS stop FROM (
        SELECT r, hits[i] AS hit, inners[i] AS inner_hit, coalesce(list_sum(list_transform(pieces[:i], lambda p: length(p))), 0)::BIGINT
            + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0)::BIGINT AS start
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
            SELECT r, string_split_regex(text, {_quoted(pattern)}) AS pieces, regexp_extract_all(text, {_quoted(pattern)}, 0) AS hits,
                regexp_extract_all(text, {_quoted(pattern)}, {group}) AS inners FROM docs))) WHERE {kept}"""


_MATERIAL_SQL = " AND ".join(f"regexp_matches(hit, '{p}')" for p in ("^[A-Za-z0-9+/]+={0,2}$", "[0-9]", "[A-Z]", "[a-z]"))
_ROLE_SQL = "CASE " + " ".join(f"WHEN kind = '{k}' THEN '{v}'" for k, v in secret_scan.ROLES.items()) + " END"
_LIST_SQL = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop){}, '')"
SECRETS_SQL = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    base AS ({_spans_sql("assign", 0, secret_scan.ASSIGN, "length(inner_hit) >= 12", 2)}
        UNION ALL {_spans_sql("access", 1, secret_scan.ACCESS)} UNION ALL {_spans_sql("hex", 2, secret_scan.HEX)}),
    weak AS (SELECT * FROM ({_spans_sql("endpoint", 3, secret_scan.ENDPOINT)} UNION ALL {_spans_sql("identifier", 4, secret_scan.IDENTIFIER)}
        UNION ALL {_spans_sql("material", 5, secret_scan.MATERIAL, _MATERIAL_SQL)}) w
        WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = w.r AND b.start < w.stop AND w.start < b.stop)),
    parts AS (SELECT *, {_ROLE_SQL} AS role FROM (SELECT * FROM base UNION ALL SELECT * FROM weak)),
    linked AS (SELECT * FROM parts w WHERE rank > 2 AND EXISTS (SELECT 1 FROM parts p WHERE p.r = w.r AND p.role <> w.role
        AND p.start <= w.stop + {secret_scan.SCOPE} AND p.stop + {secret_scan.SCOPE} >= w.start)),
    every AS (SELECT r, rank, kind, start, stop FROM base UNION ALL SELECT r, rank, kind, start, stop FROM linked)
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, sha256({_LIST_SQL.format(" FILTER (rank <= 2)")}) AS base_sha256,
        {_LIST_SQL.format(" FILTER (kind IS NOT NULL)")} AS spans
    FROM docs LEFT JOIN every USING (r) GROUP BY r, doc_id"""


@query("op9_secret_scan", SECRETS_SQL)
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, ("assign", "access", "hex")), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "linked")).alias("spans"),
    )


def _tokens_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(regexp_replace({text}, {_quoted(decontaminate.JUNK)}, '', 'g')), '\\s+'), lambda x: x <> '')"


def _template_sql(names: bool) -> str:
    out = f"regexp_replace(coalesce(text, ''), {_quoted(decontaminate.NUMBERS)}, chr(1), 'g')"
    for _ in range(2 if names else 0):  # without lookbehind a match takes the end of the token before it, which may be a name itself
        out = f"regexp_replace({out}, '([^.!?:\\s]\\x20)\\p{{Lu}}\\p{{Ll}}+', '\\1' || chr(2), 'g')"
    return f"regexp_replace({out}, {_quoted(decontaminate.UNITS_AFTER)}, '\\1' || chr(3), 'g')"


def _windows_sql(source: str, names: bool) -> str:
    return f"""SELECT r, id, i - 1 AS pos, c[i:i + 7] AS win, list_filter(list_transform(range(i, i + 8), lambda k: CASE WHEN regexp_matches(c[k], '[\\x01-\\x03]') THEN o[k] END),
        lambda v: v IS NOT NULL) AS slots FROM (SELECT *, unnest(range(1, len(c) - 6)) AS i FROM (
            SELECT r, id, {_tokens_sql(_template_sql(names))} AS c, {_tokens_sql("coalesce(text, '')")} AS o FROM {source}) WHERE len(c) >= 8)"""


LEAKS_SQL = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id AS id, text FROM documents),
    items AS (SELECT row_number() OVER () AS r, item_id AS id, text FROM benchmark),
    index AS (SELECT DISTINCT *, max(pos) OVER (PARTITION BY r) + 1 AS n FROM ({_windows_sql("items", True)} UNION ALL {_windows_sql("items", False)})),
    met AS (SELECT d.r, i.r AS ir, i.id AS item, i.n, d.pos - i.pos AS shift, i.pos AS ipos, i.slots AS a, d.slots AS b
        FROM ({_windows_sql("docs", True)}) d JOIN index i ON d.win = i.win WHERE len(i.slots) <= 4),
    aligned AS (SELECT r, ir, item, n, shift, count(DISTINCT ipos) AS hits, flatten(list(list_zip(a, b))) AS pairs FROM met GROUP BY ALL),
    leaked AS (SELECT r, item, max(hits) AS hits FROM aligned WHERE hits >= least(n, 6)
        AND len(list_distinct(pairs)) = len(list_distinct(list_transform(pairs, lambda p: p[1]))) GROUP BY r, item)
    SELECT d.id AS doc_id, count(l.item) > 0 AS contaminated, coalesce(list(l.item ORDER BY l.item) FILTER (l.item IS NOT NULL), []) AS items,
        coalesce(sum(l.hits), 0)::BIGINT AS n_windows
    FROM docs d LEFT JOIN leaked l USING (r) GROUP BY d.r, d.id"""


@query("op4_decontaminate", LEAKS_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.mark_leaks(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    )


@query("op6_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op2_top_k", """
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op5_repeated_passages")
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_lm_score")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, fit_lm(docs)).select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


FAILED_SQL = r"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    tests AS (SELECT r, doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM docs),
    said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    failed AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
        || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n,
        count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM tests LEFT JOIN said USING (doc_id) GROUP BY ALL)"""

AUDIT_SQL = FAILED_SQL + """,
    letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a JOIN letter b ON b.f <> a.f JOIN letter c ON c.f NOT IN (a.f, b.f)
        JOIN letter d ON d.f NOT IN (a.f, b.f, c.f) JOIN letter e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
    steps AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders),
    met AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, fails, n, good, toxic, contains(fails, substr(filter_order, step, 1)) AS here,
        translate(fails, substr(filter_order, 1, step - 1), '') <> fails AS before FROM steps CROSS JOIN failed),
    counted AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT here AND NOT before), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (here AND NOT before), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (here AND before), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (here AND NOT before), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT before), 0)::BIGINT AS toxic_lost FROM met GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""


@query("op11_filter_audit", AUDIT_SQL)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(
        table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    )


SHARDS = 24


@query("op12_reshard")
def resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source lies in one old shard, by its name; the flow brings the 24 shards to equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    sized = docs.select(
        "doc_id", (F.length(text) + 8).cast("long").alias("bytes"), F.crc32(text).alias("text_crc32"),
        F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(SHARDS)).cast("int").alias("home"),
    )
    layout = flow_layout(sized, F.col("bytes"), F.col("home"), SHARDS, SHARDS, ["doc_id", "text_crc32", "bytes"])
    return layout.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


@query("op13_periodic_runs")
def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In every tenth document, by the hash of its id, the words after one place repeat the stretch that begins there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n, a, p = (F.col(c) for c in "gnap")
    repeated = docs.where((h % 10 == 0) & F.col("text").isNotNull()).select("doc_id", words.alias("w"), F.floor(h / 10).alias("g"), F.size(words).alias("n"))
    repeated = repeated.withColumn("a", F.when(n > 0, g % n).otherwise(0)).withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)))
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.element_at("w", (a + (i - a) % p + 1).cast("int")))
    again = F.when(n > 0, F.concat(F.slice("w", F.lit(1), a.cast("int")), tail)).otherwise(F.col("w"))
    texts = docs.where(F.coalesce(h % 10 != 0, F.lit(True)) | F.col("text").isNull()).unionByName(repeated.select("doc_id", F.array_join(again, " ").alias("text")))
    found = periodic_runs(texts)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best, period = F.col("best"), -F.col("best.q")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"), best["length"].alias("length"), period.alias("period"),
        F.floor(1000 * best["length"] / period).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
