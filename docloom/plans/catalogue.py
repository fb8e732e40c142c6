"""Registered queries over the library's own operators, with their SQL counterparts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as X
from docloom.operators import backfill, parse, postings, search
from docloom.operators.chunk import chunk, large_cases, line_paragraphs, totals
from docloom.operators.embed import TooLong, embed
from docloom.operators.html import Selector, select_texts
from docloom.operators.points import batches, points
from docloom.operators.store import Collection
from docloom.operators.vector_index import VectorIndex, vector_topk
from docloom.sources import scans
from docloom.streaming import loads

QUERIES: dict = {}
ORACLES: dict = {}
TERMS = "the that with"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _chunked(spark: SparkSession, sf_dir: str, target: int) -> DataFrame:
    docs = scans.read_table(spark, sf_dir, "documents").select("doc_id", line_paragraphs("text").alias("paragraphs"))
    return chunk(docs, "doc_id", "paragraphs", target)


def _paragraph_sql(target: int) -> str:
    """Paragraphs after long ones are split, with their words; then the greedy walk over their prefix sums."""
    return rf"""
l AS (SELECT doc_id, p, list_filter(regexp_split_to_array(line, '[{X.SPACE}]+'), lambda x: x <> '') AS words
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents)),
s AS (SELECT doc_id, p, k, words[k * {target} + 1:(k + 1) * {target}] AS part FROM (SELECT *, unnest(range(0, (len(words) + {target - 1}) // {target})) AS k FROM l)),
para AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p, k) AS i, len(part) AS w, array_to_string(part, ' ') AS t FROM s),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto, count(*) OVER (PARTITION BY doc_id) AS n FROM para),
e AS (SELECT a.doc_id, a.i, any_value(a.n) AS n, greatest(a.i, max(b.i)) AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND (b.i = a.i OR b.upto - a.upto + a.w <= {target}) GROUP BY a.doc_id, a.i),
walk AS (SELECT doc_id, 0 AS chunk_index, i, stop, n FROM e WHERE i = 1
         UNION ALL SELECT e.doc_id, w.chunk_index + 1, e.i, e.stop, e.n FROM walk w JOIN e ON e.doc_id = w.doc_id AND e.i = greatest(w.stop, w.i + 1) WHERE w.stop < w.n)"""


def _collection(spark: SparkSession, key: str, width: int = 1 << 22, text: str | None = None) -> Collection:
    """A new collection in the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="docloom-")
    return Collection(spark, f"{base}/collection-{uuid.uuid4().hex}", key, width, text=text)


def _few(spark: SparkSession, collection: Collection, rows: list, schema) -> DataFrame:
    """A short result, for which the collection isn't needed any more."""
    collection.files.delete("")
    return spark.createDataFrame(rows, schema)


# ---- scans, filters, sinks


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 7 LIMIT 1")
def s1_point_lookup(spark, sf_dir):
    return scans.point_lookup(scans.read_table(spark, sf_dir, "orders"), "o_orderkey", 7).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1")
def s2_first_row(spark, sf_dir):
    return scans.first_row(scans.read_table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id > 10 AND text IS NOT NULL ORDER BY doc_id LIMIT 100")
def s3_keyset_page(spark, sf_dir):
    return scans.keyset_page(scans.read_table(spark, sf_dir, "documents"), "doc_id", 10, 100, "text").select("doc_id", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id > 20 AND doc_id <= 700 AND text IS NOT NULL")
def s4_keyset_range(spark, sf_dir):
    return scans.keyset_range(scans.read_table(spark, sf_dir, "documents"), "doc_id", 20, 700, "text").select("doc_id", F.md5("text").alias("text_md5"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id >= 40 ORDER BY vec_id LIMIT 101")
def s7_scroll_page(spark, sf_dir):
    return scans.scroll(scans.read_table(spark, sf_dir, "embeddings"), "vec_id", 40, 100, ["label"])


@query("SELECT conv_id, turn, role FROM conversations WHERE text IS NOT NULL AND text <> ''")
def f2_nonempty(spark, sf_dir):
    return scans.nonempty(scans.read_table(spark, sf_dir, "conversations"), "text").select("conv_id", "turn", "role")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id > 500")
def f6_ahead(spark, sf_dir):
    return scans.ahead(scans.read_table(spark, sf_dir, "documents"), "doc_id", 500).select("doc_id", "n_chars")


@query("""SELECT o_orderkey, o_orderstatus AS stored, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS computed FROM orders
          WHERE o_orderstatus IS DISTINCT FROM CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END""")
def f8_changed_rows(spark, sf_dir):
    both = scans.read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("stored"), F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("computed"))
    return scans.changed(both, "stored", "computed")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders")
def k3_upsert(spark, sf_dir):
    """Rows of keys 0 mod 4 are updated, those of 1 mod 4 are new, the others stay."""
    orders = scans.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    collection = _collection(spark, "o_orderkey")
    collection.upsert(orders.where("o_orderkey % 4 <> 1"))
    collection.upsert(orders.where("o_orderkey % 4 < 2").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return collection.read()


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'late' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def k6_set_payload(spark, sf_dir):
    orders = scans.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    collection = _collection(spark, "o_orderkey")
    collection.upsert(orders)
    collection.set_payload(orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("late").alias("o_orderpriority")))
    return collection.read()


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1995")
def k7_payload_index(spark, sf_dir):
    """Rows by an indexed payload column that was written after the rows."""
    orders = scans.read_table(spark, sf_dir, "orders")
    collection = _collection(spark, "o_orderkey")
    collection.create_index("year")
    collection.upsert(orders.select("o_orderkey"))
    collection.set_payload(orders.select("o_orderkey", F.year("o_orderdate").alias("year")))
    return collection.where("year", 1994, 1995)


@query(f"""WITH RECURSIVE {_paragraph_sql(600)} SELECT count(DISTINCT doc_id) AS cases, count(*) AS chunks, CAST(4 AS BIGINT) AS batches FROM walk""")
def w1_load_totals(spark, sf_dir):
    """Counters of a load of all documents in four batches, of which one is sent twice."""
    chunks = _chunked(spark, sf_dir, 600).select(X.point_id("doc_id", "chunk_index").alias("id"), F.col("doc_id").alias("case_id"), "text")
    collection = _collection(spark, "id", 1 << 32)
    for batch in (0, 1, 2, 3, 0):
        told = lambda points: loads.counters(points) | {"seconds": 0.0}
        collection.upsert(chunks.where(F.col("case_id") % 4 == batch), batch=f"part-{batch}", count=told)
    found = loads.totals(collection)
    return _few(spark, collection, [(found["cases"], found["chunks"], found["batches"])], "cases long, chunks long, batches long")


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS utf8_bytes FROM documents WHERE text IS NOT NULL")
def x17_utf8_bytes(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.octet_length("text").cast("long").alias("utf8_bytes"))


@query("""WITH RECURSIVE l AS (SELECT l_suppkey, (l_orderkey * 100 + l_linenumber) * 1000000000 + l_partkey AS line, repeat('x', CAST(l_quantity AS BIGINT)) AS pad FROM lineitem),
s AS (SELECT l_suppkey, line, 31 + length(l_suppkey::VARCHAR) + length(line::VARCHAR) + length(pad) AS bytes, row_number() OVER (PARTITION BY l_suppkey ORDER BY line) AS i FROM l),
k AS (SELECT l_suppkey, line, bytes, i, bytes AS used, 1 AS n, CAST(0 AS BIGINT) AS batch FROM s WHERE i = 1
      UNION ALL SELECT s.l_suppkey, s.line, s.bytes, s.i, CASE WHEN k.used + s.bytes > 1500 OR k.n >= 25 THEN s.bytes ELSE k.used + s.bytes END,
             CASE WHEN k.used + s.bytes > 1500 OR k.n >= 25 THEN 1 ELSE k.n + 1 END, k.batch + CASE WHEN k.used + s.bytes > 1500 OR k.n >= 25 THEN 1 ELSE 0 END
      FROM k JOIN s ON s.l_suppkey = k.l_suppkey AND s.i = k.i + 1)
SELECT l_suppkey, line, CAST(bytes AS BIGINT) AS bytes, batch FROM k""")
def k5_batches(spark, sf_dir):
    """Write batches of a supplier's lines: some end at their bytes, some at 25 points."""
    lines = scans.read_table(spark, sf_dir, "lineitem").select("l_suppkey", ((F.col("l_orderkey") * 100 + F.col("l_linenumber")) * 1000000000 + F.col("l_partkey")).alias("line"), F.repeat(F.lit("x"), F.col("l_quantity").cast("int")).alias("pad"))
    return batches(lines, "l_suppkey", "line", 1500, 25)


@query("""WITH RECURSIVE l AS (SELECT l_suppkey, (l_orderkey * 100 + l_linenumber) * 1000000000 + l_partkey AS line, repeat('x', CAST(l_quantity AS BIGINT)) AS pad FROM lineitem)
SELECT l_suppkey, count(*) AS points, CAST(sum(31 + length(l_suppkey::VARCHAR) + length(line::VARCHAR) + length(pad)) AS BIGINT) AS bytes FROM l GROUP BY l_suppkey""")
def a7_batch_bytes(spark, sf_dir):
    """Points and JSON bytes of each supplier's batches in all."""
    sized = k5_batches(spark, sf_dir).groupBy("l_suppkey", "batch").agg(F.count("*").alias("points"), F.sum("bytes").alias("bytes"))
    return sized.groupBy("l_suppkey").agg(F.sum("points").alias("points"), F.sum("bytes").alias("bytes"))


# ---- scalars


@query(rf"""WITH t AS (SELECT doc_id, replace(text, '&', '+') AS t FROM documents)
SELECT doc_id, md5(trim(regexp_replace(CASE doc_id % 5 WHEN 0 THEN replace(t, ' ', chr(160)) WHEN 1 THEN replace(t, ' ', chr(9) || ' ') WHEN 3 THEN replace(replace(t, 'a', 'á'), 'e', 'é')
       WHEN 4 THEN replace(t, 'o', '&ouml;<') ELSE t END, '[{X.SPACE}]+', ' ', 'g'), ' ')) AS text_md5 FROM t""")
def x1_normalize(spark, sf_dir):
    """Texts with other white space and with character references, which are decoded once."""
    t, each = F.replace("text", F.lit("&"), F.lit("+")), F.col("doc_id") % 5
    put = lambda c, old, new: F.replace(c, F.lit(old), F.lit(new))
    odd = F.when(each == 0, put(t, " ", "\u00a0")).when(each == 1, put(t, " ", "\t ")).when(each == 2, put(t, " ", "&nbsp;"))
    odd = odd.when(each == 3, put(put(t, "a", "&#225;"), "e", "&#xE9;")).when(each == 4, put(t, "o", "&amp;ouml;&#60;")).otherwise(t)
    return scans.read_table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalize_inline(odd, decode=True)).alias("text_md5"))


#: Items of one and several words between separators, with empty ones, blanks of several kinds and a separator at the end.
LISTED_SQL = """trim(regexp_replace(p_name || '{a}' || p_type || chr(9) || ' ' || p_brand || '{b}' || p_name || ' ' || p_type || '{a}{a}' || p_size || chr(10) || '{b}', '[\\t\\n ]+', ' ', 'g'), ' ')"""


def _listed(a: str, b: str) -> Column:
    size = F.col("p_size").cast("string")
    return F.concat("p_name", F.lit(a), "p_type", F.lit("\t "), "p_brand", F.lit(b), "p_name", F.lit(" "), "p_type", F.lit(a + a), size, F.lit("\n" + b))


@query(f"""SELECT p_partkey, array_to_string(list_filter(regexp_split_to_array({LISTED_SQL.format(a=", ", b=" ,,")}, ' ?, ?'), lambda x: x <> ''), '#') AS items FROM part""")
def x4_comma_list(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.comma_list(_listed(", ", " ,,")), "#").alias("items"))


@query(rf"""SELECT p_partkey, array_to_string(list_filter(list_transform(regexp_split_to_array({LISTED_SQL.format(a=" ; ", b="|")}, ' ?; ?| ?\| ?| ?, ?'),
          lambda x: regexp_replace(trim(x, ' '), '^[,;]+|[,;]+$', '', 'g')), lambda x: x <> ''), '#') AS items FROM part""")
def x5_loose_list(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.loose_list(_listed(" ; ", "|")), "#").alias("items"))


@query(rf"""WITH t AS (SELECT doc_id, replace(replace(text, '. ', '.' || chr(9) || chr(10) || ' ' || chr(10) || chr(10)), ', ', ',' || chr(160) || '  ') AS t FROM documents)
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(160), ' '), '[ \t]+', ' ', 'g'), '[{X.SPACE}]*\n[{X.SPACE}]*', chr(10), 'g'), '^[{X.SPACE}]+|[{X.SPACE}]+$', '', 'g')) AS text_md5 FROM t""")
def x2_normalize_lines(spark, sf_dir):
    """Texts with blank lines, tabs and no-break spaces; line ends stay."""
    odd = F.replace(F.replace("text", F.lit(". "), F.lit(".\t\n \n\n")), F.lit(", "), F.lit(",\u00a0  "))
    return scans.read_table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalize_lines(odd)).alias("text_md5"))


@query(rf"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '[' || doc_id || '] ' WHEN 1 THEN '(' || doc_id || ')' ELSE doc_id || '. ' END || text AS t FROM documents)
SELECT doc_id, CAST(regexp_extract(t, '^[\[(]?([0-9]+)[\]).]', 1) AS BIGINT) AS para_no,
       md5(trim(regexp_replace(regexp_extract(t, '(?s)^[\[(]?[0-9]+[\]).][{X.SPACE}]*(.*)$', 1), '[{X.SPACE}]+', ' ', 'g'), ' ')) AS text_md5 FROM t""")
def x6_para_number(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    front = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), key, F.lit("] "))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("("), key, F.lit(")"))).otherwise(F.concat(key, F.lit(". ")))
    parsed = scans.read_table(spark, sf_dir, "documents").select("doc_id", X.paragraph_number(F.concat(front, F.col("text"))).alias("p"))
    return parsed.select("doc_id", "p.para_no", F.md5("p.text").alias("text_md5"))


@query(rf"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[{X.SPACE}]+'), lambda x: x <> '')) AS words FROM documents")
def x7_word_count(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "documents").select("doc_id", X.word_count("text").cast("long").alias("words"))


@query("""SELECT doc_id, md5(concat_ws(chr(10), CASE WHEN source <> '' THEN 'title: ' || source END, CASE WHEN lang <> '' THEN 'court: ' || lang END, 'judges: ' || source || ', ' || lang, 'text: ' || text)) AS sparse_md5 FROM documents""")
def x9_sparse_text(spark, sf_dir):
    df = scans.read_table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("title"), F.col("lang").alias("court"), F.array("source", "lang").alias("judges"))
    return df.select("doc_id", F.md5(X.sparse_text("text", {"title": "title", "court": "court"}, {"judges": "judges"})).alias("sparse_md5"))


@query("SELECT l_orderkey * 100000 + l_linenumber AS id, l_orderkey || '_' || l_linenumber AS chunk_id FROM lineitem")
def x10_point_id(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "lineitem").select(X.point_id("l_orderkey", "l_linenumber").alias("id"), X.chunk_id("l_orderkey", "l_linenumber").alias("chunk_id"))


COURT_SQL = f"CASE WHEN (o_custkey * 100000 + o_orderkey % 100000) // 100000 IN ({', '.join(map(str, X.COURTS))}) THEN (o_custkey * 100000 + o_orderkey % 100000) // 100000 END"


def _running(spark, sf_dir):
    orders = scans.read_table(spark, sf_dir, "orders")
    return orders.withColumn("running", F.format_number(F.col("o_custkey") * 100000 + F.col("o_orderkey") % 100000, 0))


@query(f"SELECT o_orderkey, {COURT_SQL} AS court_id FROM orders")
def x13_court_id(spark, sf_dir):
    return _running(spark, sf_dir).select("o_orderkey", X.court_id("running").alias("court_id"))


@query("SELECT doc_id, md5(left(coalesce(text, ''), 1500)) AS dense_md5, md5(left(coalesce(text, ''), 1800)) AS hybrid_md5 FROM documents")
def x15_prefixes(spark, sf_dir):
    return scans.read_table(spark, sf_dir, "documents").select("doc_id", F.md5(X.prefix("text", 1500)).alias("dense_md5"), F.md5(X.prefix("text", 1800)).alias("hybrid_md5"))


@query("SELECT o_orderkey, 1 + o_custkey % 9 AS attempt, CAST(least(2000 * pow(2.0, o_custkey % 9), 60000) AS BIGINT) AS delay_ms FROM orders")
def x18_backoff(spark, sf_dir):
    tried = scans.read_table(spark, sf_dir, "orders").select("o_orderkey", (1 + F.col("o_custkey") % 9).alias("attempt"))
    return tried.select("o_orderkey", "attempt", X.backoff_ms("attempt", 2000, 60000).alias("delay_ms"))


DATE_SQL = "CASE WHEN o_orderkey % 7 = 0 THEN '31 February 1950' ELSE strftime(o_orderdate, '%d %B %Y') END"


def _dated(spark, sf_dir):
    orders = scans.read_table(spark, sf_dir, "orders")
    return orders.withColumn("date_of_decision", F.when(F.col("o_orderkey") % 7 == 0, "31 February 1950").otherwise(F.date_format("o_orderdate", "dd MMMM yyyy")))


@query(f"""SELECT o_orderkey, strftime(try_strptime({DATE_SQL}, '%d %B %Y'), '%Y-%m-%d') AS decision_date, CAST(year(try_strptime({DATE_SQL}, '%d %B %Y')) AS INTEGER) AS decision_year FROM orders""")
def d1_decision_date(spark, sf_dir):
    parsed = _dated(spark, sf_dir).select("o_orderkey", X.decision_date("date_of_decision").alias("d"))
    return parsed.select("o_orderkey", F.date_format("d.decision_date", "yyyy-MM-dd").alias("decision_date"), "d.decision_year")


# ---- passages


@query(rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[{X.SPACE}]+'), lambda x: x <> '') AS words FROM documents)
SELECT doc_id, window_no, md5(CASE WHEN len(words) <= 50 THEN regexp_replace(text, '^[{X.SPACE}]+|[{X.SPACE}]+$', '', 'g') ELSE array_to_string(words[window_no * 50 + 1:(window_no + 1) * 50], ' ') END) AS text_md5
FROM (SELECT *, unnest(range(0, greatest(1, (len(words) + 49) // 50))) AS window_no FROM w JOIN documents USING (doc_id))""")
def c1_word_windows(spark, sf_dir):
    docs = scans.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(X.word_windows("text", 50)).alias("window_no", "t")).select("doc_id", F.col("window_no").cast("long"), F.md5("t").alias("text_md5"))


@query(f"""WITH RECURSIVE {_paragraph_sql(600)}
SELECT w.doc_id, w.chunk_index, CAST(w.i AS INTEGER) AS paragraph_start, CAST(w.stop AS INTEGER) AS paragraph_end, CAST(sum(c.w) AS INTEGER) AS word_count, md5(string_agg(c.t, chr(10) || chr(10) ORDER BY c.i)) AS text_md5
FROM walk w JOIN c ON c.doc_id = w.doc_id AND c.i BETWEEN w.i AND w.stop GROUP BY w.doc_id, w.chunk_index, w.i, w.stop""")
def c6_chunks(spark, sf_dir):
    return _chunked(spark, sf_dir, 600).select("doc_id", "chunk_index", "paragraph_start", "paragraph_end", "word_count", F.md5("text").alias("text_md5"))


@query(f"""WITH RECURSIVE {_paragraph_sql(100)} SELECT count(DISTINCT doc_id) AS cases, count(*) AS chunks FROM walk""")
def a1_counters(spark, sf_dir):
    return totals(_chunked(spark, sf_dir, 100), "doc_id")


@query(f"""WITH RECURSIVE {_paragraph_sql(100)} SELECT doc_id, count(*) AS chunks FROM walk GROUP BY doc_id HAVING count(*) > 20""")
def e7_large_cases(spark, sf_dir):
    return large_cases(_chunked(spark, sf_dir, 100), "doc_id", 20)


@query(f"""WITH RECURSIVE {_paragraph_sql(100)}, n AS (SELECT doc_id, count(*) * 10 AS chunks FROM walk GROUP BY doc_id)
SELECT doc_id, chunks, CASE WHEN chunks > 500 THEN 8 WHEN chunks > 200 THEN 12 ELSE 24 END AS batch FROM n""")
def e5_adaptive_batch(spark, sf_dir):
    counts = _chunked(spark, sf_dir, 100).groupBy("doc_id").agg((F.count("*") * 10).alias("chunks"))
    return counts.select("doc_id", "chunks", X.adaptive_batch("chunks").alias("batch"))


# ---- HTML


def _web(spark, sf_dir):
    pages = scans.read_table(spark, sf_dir, "pages")
    return parse.parse_cases(pages.select(F.col("page_id").alias("file_name"), F.lit(None).cast("string").alias("ftype"), F.lit(None).cast("int").alias("flag"), "html"), parse.WEB)


def _clean_sql(html: str) -> str:
    for name, character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        html = f"replace({html}, '&{name};', '{character}')"
    return f"trim(regexp_replace({html}, '[{X.SPACE}]+', ' ', 'g'), ' ')"


@query(f"""SELECT page_id, nullif({_clean_sql("regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g')")}, '') AS title FROM pages""")
def h2_title(spark, sf_dir):
    return _web(spark, sf_dir).select(F.col("case_id").alias("page_id"), "title")


@query(f"""WITH a AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<a [^>]*>(.*?)</a>', 1) AS t FROM pages),
x AS (SELECT page_id, {_clean_sql("u")} AS t, i FROM (SELECT page_id, unnest(t) AS u, generate_subscripts(t, 1) AS i FROM a)),
f AS (SELECT page_id, t, min(i) AS i FROM x WHERE t <> '' GROUP BY page_id, t)
SELECT p.page_id, coalesce(string_agg(f.t, '|' ORDER BY f.i), '') AS links FROM pages p LEFT JOIN f USING (page_id) GROUP BY p.page_id""")
def h5_links(spark, sf_dir):
    return _web(spark, sf_dir).select(F.col("case_id").alias("page_id"), F.array_join("acts_referred", "|").alias("links"))


JUDGES = "Hon'ble Judges"


def _judgments(spark, sf_dir, *wanted):
    """The ``wanted`` columns, or all, of judgment pages written from the columns of orders: some without a title or court, with a lead line, double paragraphs, acts with or without links."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    some = lambda n, *parts: F.when(F.col("o_orderkey") % n != 0, F.concat(*map(_lit, parts))).otherwise("")
    html = F.concat(
        F.lit("<html><body>"), some(5, '<div class="judgtitle">Case ', key, "<br>versus <b>State &amp; Another</b></div>"), some(4, '<p class="highcourt"> Court&nbsp;of ', F.col("o_orderpriority"), "</p>"),
        _lit('<p class="judgdate">Date of Decision : '), F.date_format("o_orderdate", "dd MMMM yyyy"), _lit('</p><p class="citations">Citation: '), key, _lit(" SCC<br>"), cust,
        _lit('</p><p class="apptype">Case Type : Appeal</p><p class="appealno">CASE NO:'), key, _lit("/"), cust, _lit(f'</p><p class="judges">{JUDGES}: A. '), cust, _lit(" , B. Roe,</p>"),
        _lit('<p class="eqcitations">Eq. Citations : X '), key, _lit(", Y 2</p><p class=\"advocate\">Advocates: </p><p class=\"fd\">Subject : Tax "), cust, _lit('</p><p class="fd">Final Decision: Allowed</p>'),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(_lit('<div class="acts"><a>Act '), cust, _lit("</a><a> Act "), cust, _lit("</a><a>Act Z</a></div>"))).otherwise(F.concat(_lit('<div class="acts">Acts Referred: A '), cust, _lit("; B | C, D</div>"))),
        _lit('<p><a id="aCaseCited">Cited</a> <b>'), cust, _lit("</b></p>"), F.when(F.col("o_orderkey") % 3 == 0, '<p class="judgpara">A. Name, J. -</p>').otherwise(""),
        _lit('<p class="judgpara">[1] First &lt;'), key, _lit('&gt;</p><p class="judgspara">(2) Sub '), cust, _lit('</p><p class="judgpara">3. Third</p><p class="judgpara">3. Third</p><p class="judgpara">Judgement Text :</p><p class="judgpara">1.5 percent<script>x</script></p></body></html>'),
    )
    orders = scans.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    # A small file is one partition, but parsing the pages made of its rows is long: the narrow rows are dealt out first.
    orders = orders.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return parse.parse_cases(orders.select(F.col("o_orderkey").alias("file_name"), F.lit("J").alias("ftype"), F.lit(1).alias("flag"), html.alias("html")), wanted=wanted or parse.RESULT)


def _lit(value):
    return F.lit(value) if isinstance(value, str) else value


@query("""SELECT o_orderkey AS case_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'Case ' || o_orderkey || ' versus State & Another' END AS title, CASE WHEN o_orderkey % 4 <> 0 THEN 'Court of ' || o_orderpriority END AS court,
       strftime(o_orderdate, '%d %B %Y') AS date_of_decision, o_orderkey || ' SCC' || o_custkey AS citation, 'Appeal' AS case_type, o_orderkey || '/' || o_custkey AS case_no, 'Tax ' || o_custkey AS subject, 'Allowed' AS final_decision,
       CAST(o_custkey AS DOUBLE) AS cited FROM orders""")
def h3_judgment_metadata(spark, sf_dir):
    return _judgments(spark, sf_dir, "case_id", "title", "court", "date_of_decision", "citation", "case_type", "case_no", "subject", "final_decision", "cited")


@query("""SELECT o_orderkey AS case_id, 'A. ' || o_custkey || '|B. Roe' AS judges, 'X ' || o_orderkey || '|Y 2' AS equivalent_citations, '' AS advocates,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Act ' || o_custkey || '|Act Z' ELSE 'A ' || o_custkey || '|B|C|D' END AS acts_referred FROM orders""")
def h4_judgment_lists(spark, sf_dir):
    lists = ("judges", "equivalent_citations", "advocates", "acts_referred")
    return _judgments(spark, sf_dir, "case_id", *lists).select("case_id", *(F.array_join(c, "|").alias(c) for c in lists))


@query("""SELECT o_orderkey AS case_id, i AS place, CASE i WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 END AS para_no,
       CASE i WHEN 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'A. Name, J. - ' ELSE '' END || 'First <' || o_orderkey || '>' WHEN 1 THEN 'Sub ' || o_custkey WHEN 2 THEN 'Third' ELSE '5 percent' END AS text,
       CASE WHEN i = 1 THEN 'judgspara' ELSE 'judgpara' END AS source_class, CASE WHEN i = 1 THEN 'subpoint' ELSE 'main' END AS role
FROM (SELECT *, unnest(range(4)) AS i FROM orders)""")
def h9_judgment_paragraphs(spark, sf_dir):
    found = _judgments(spark, sf_dir, "case_id", "paragraphs").select("case_id", F.posexplode("paragraphs").alias("place", "p"))
    return found.select("case_id", F.col("place").cast("long"), F.col("p.para_no").cast("int").alias("para_no"), "p.text", "p.source_class", "p.role")


@query("""SELECT o_orderkey AS case_id, md5('[1] ' || CASE WHEN o_orderkey % 3 = 0 THEN 'A. Name, J. - ' ELSE '' END || 'First <' || o_orderkey || '>' || chr(10) || chr(10) || '[2] Sub ' || o_custkey || chr(10) || chr(10) || '[3] Third' || chr(10) || chr(10) || '[1] 5 percent') AS full_text_md5,
       concat_ws(', ', CASE WHEN o_orderkey % 5 = 0 THEN 'no title found' END, CASE WHEN o_orderkey % 4 = 0 THEN 'no court found' END) AS warnings FROM orders""")
def h16_judgment_text(spark, sf_dir):
    return _judgments(spark, sf_dir, "case_id", "full_text", "warnings").select("case_id", F.md5("full_text").alias("full_text_md5"), F.array_join("warnings", ", ").alias("warnings"))


@query("""SELECT o_orderkey * 100000 AS id, o_orderkey || '_0' AS chunk_id, 1 AS paragraph_start, 4 AS paragraph_end, o_orderkey AS case_id, 'J' AS ftype, '[1] 5 percent' AS last_line,
       'judges: A. ' || o_custkey || ', B. Roe' AS judges_line, 'acts referred: ' || CASE WHEN o_orderkey % 2 = 0 THEN 'Act ' || o_custkey || ', Act Z' ELSE 'A ' || o_custkey || ', B, C, D' END AS acts_line,
       CASE WHEN o_orderkey % 5 <> 0 THEN 'title: Case ' || o_orderkey || ' versus State & Another' ELSE 'citation: ' || o_orderkey || ' SCC' || o_custkey END AS first_line FROM orders""")
def f5_points(spark, sf_dir):
    """Judgments as points: ids, the payload of the case and of the passage, and the sparse text's lines."""
    cases = _judgments(spark, sf_dir)
    found = points(chunk(cases, "case_id", "paragraphs", 600, carry=[c for c in parse.CASE_COLUMNS if c != "case_id"]))
    lines = F.split("sparse_text", "\n")
    labelled = lambda name: F.get(F.filter(lines, lambda x: x.startswith(f"{name}: ")), F.lit(0)).alias(f"{name.split()[0]}_line")
    return found.select("id", "chunk_id", "paragraph_start", "paragraph_end", "case_id", "ftype", F.element_at(F.split("text", "\n"), -1).alias("last_line"), labelled("judges"), labelled("acts referred"), F.get(lines, F.lit(0)).alias("first_line"))


ARTICLE_SQL = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"


def _visible_sql(html: str) -> str:
    """An element's text: breaks are spaces, other tags nothing."""
    return _clean_sql(f"regexp_replace(replace({html}, '<br>', ' '), '<[^>]+>', '', 'g')")


@query(rf"""WITH x AS (SELECT page_id, unnest(string_split({ARTICLE_SQL}, '<p>')) AS part, generate_subscripts(string_split({ARTICLE_SQL}, '<p>'), 1) AS i FROM pages),
t AS (SELECT page_id, {_visible_sql("part")} AS text, i FROM x WHERE i > 1),
f AS (SELECT page_id, text, min(i) AS i FROM t WHERE text <> '' AND NOT regexp_matches(text, '(?i)^judgement text\s*:?\s*$') GROUP BY page_id, text)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, CAST(NULL AS BIGINT) AS para_no, text, 'main' AS role FROM f""")
def h9_paragraphs(spark, sf_dir):
    return _web(spark, sf_dir).select(F.col("case_id").alias("page_id"), F.posexplode("paragraphs").alias("position", "p")).select("page_id", "position", "p.para_no", "p.text", "p.role")


@query(f"SELECT page_id, {_visible_sql(ARTICLE_SQL)} AS body FROM pages")
def h10_text(spark, sf_dir):
    found = select_texts(scans.read_table(spark, sf_dir, "pages").select("page_id", "html"), "html", {"body": Selector("article", "space", 1)}, parse.WEB.open_references)
    return found.select("page_id", F.array_join(F.transform("body", lambda x: x["text"]), "\n").alias("body"))


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
n AS (SELECT doc_id, i, trim(regexp_replace(t, '[{X.SPACE}]+', ' ', 'g'), ' ') AS t FROM l)
SELECT doc_id, count(DISTINCT t) AS paragraphs FROM n WHERE t <> '' AND NOT regexp_matches(t, '(?i)^judgement text\s*:?\s*$') GROUP BY doc_id""")
def h12_dedup(spark, sf_dir):
    docs = scans.read_table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.transform(F.split("text", "\n"), lambda t: F.struct(X.normalize_inline(t).alias("text"), F.lit("judgpara").alias("classes"))).alias("found"))
    kept = parse.paragraphs(raw, "found", parse.JUDGMENT)
    return kept.where(F.size("paragraphs") > 0).select("doc_id", F.size("paragraphs").cast("long").alias("paragraphs"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
w AS (SELECT doc_id, i, CASE (doc_id + i) % 4 WHEN 0 THEN split_part(t, '.', 1) || ', C. J. -' WHEN 1 THEN 'per  COURT ' || left(t, i % 2) || '-:' WHEN 2 THEN left(t, 40) || ',j-' ELSE t END AS t FROM l)
SELECT doc_id, count(*) AS lines, count(*) FILTER (regexp_matches(t, '^[A-Za-z][-A-Za-z.,'' \x09-\x0D]+,[ \x09-\x0D]*([Cc][.]?[ \x09-\x0D]*)?[Jj][.]?[ \x09-\x0D]*-[ \x09-\x0D]*$')
       OR regexp_matches(lower(t), '^per[ \x09-\x0D]+court[ \x09-\x0D]*[-:]*$')) AS leads FROM w GROUP BY doc_id""")
def h14_lead_line(spark, sf_dir):
    """Lines of all documents, most of them with an ending as a judge's name line has; letters beyond ASCII make no name."""
    lines = scans.read_table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "t"))
    lines = lines.withColumn("i", F.col("i") + 1)
    told = lambda k: (F.col("doc_id") + F.col("i")) % 4 == k
    line = F.when(told(0), F.concat(F.split_part("t", F.lit("."), F.lit(1)), F.lit(", C. J. -"))).when(told(1), F.concat(F.lit("per  COURT "), F.substring("t", F.lit(1), F.col("i") % 2), F.lit("-:")))
    line = line.when(told(2), F.concat(F.substring("t", 1, 40), F.lit(",j-"))).otherwise(F.col("t"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(parse.is_lead(line)).alias("leads"))


@query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 3 END AS INTEGER) AS paragraphs, CASE WHEN c_custkey % 2 = 0 THEN 'Rao, J. - ' || c_name ELSE 'Rao, J. -' END AS first FROM customer""")
def h15_lead_merge(spark, sf_dir):
    row = lambda text, role: F.struct(F.lit(None).cast("long").alias("para_no"), text.alias("text"), F.lit("judgpara").alias("source_class"), role.alias("role"))
    second = F.when(F.col("c_custkey") % 2 == 0, "main").otherwise("subpoint")
    df = scans.read_table(spark, sf_dir, "customer").select("c_custkey", F.array(row(F.lit("Rao, J. -"), F.lit("lead")), row(F.col("c_name"), second), row(F.lit("end"), F.lit("main"))).alias("p"))
    merged = df.withColumn("p", parse.merge_lead("p"))
    return merged.select("c_custkey", F.size("p").alias("paragraphs"), F.get("p", F.lit(0))["text"].alias("first"))


# ---- backfills


def _courts(spark, sf_dir):
    stored = F.when(F.col("o_orderkey") % 2 == 0, X.court_id("running").cast("string"))
    return backfill.court_ids(_running(spark, sf_dir).select("o_orderkey", F.col("running").alias("file_name"), F.lit(None).cast("long").alias("case_id"), stored.alias("court_id")))


COURT_CLASS = f"SELECT o_orderkey, {COURT_SQL} AS c, CASE WHEN {COURT_SQL} IS NULL THEN 'missing_or_invalid' WHEN o_orderkey % 2 = 0 THEN 'already_correct' ELSE 'updated' END AS class FROM orders"


@query(f"WITH x AS ({COURT_CLASS}) SELECT c AS computed, count(*) AS points FROM x WHERE class = 'updated' GROUP BY c")
def a2_court_groups(spark, sf_dir):
    return backfill.groups(_courts(spark, sf_dir))


def _dates(spark, sf_dir):
    stored = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("date"))
    return backfill.decision_dates(_dated(spark, sf_dir).select("o_orderkey", "date_of_decision", stored.alias("decision_date"), F.year(stored).alias("decision_year")))


@query(f"""WITH x AS (SELECT o_orderkey, try_strptime({DATE_SQL}, '%d %B %Y') AS d FROM orders)
SELECT strftime(d, '%Y-%m-%d') AS decision_date, CAST(year(d) AS INTEGER) AS decision_year, count(*) AS points FROM x WHERE d IS NOT NULL AND o_orderkey % 2 <> 0 GROUP BY d""")
def a3_date_groups(spark, sf_dir):
    return backfill.groups(_dates(spark, sf_dir)).select(F.date_format("computed.decision_date", "yyyy-MM-dd").alias("decision_date"), "computed.decision_year", "points")


@query(f"""WITH x AS ({COURT_CLASS}) SELECT count(*) AS scanned, count(*) FILTER (class = 'updated') AS updated, count(*) FILTER (class = 'already_correct') AS already_correct,
          count(*) FILTER (class = 'missing_or_invalid') AS missing_or_invalid FROM x""")
def a4_backfill_summary(spark, sf_dir):
    return backfill.summary(_courts(spark, sf_dir))


@query("SELECT o_orderkey, '31 February 1950' AS date_of_decision FROM orders WHERE o_orderkey % 7 = 0 ORDER BY o_orderkey LIMIT 20")
def a5_samples(spark, sf_dir):
    return backfill.samples(_dates(spark, sf_dir), "o_orderkey").select("o_orderkey", "date_of_decision")


# ---- retrieval


def _query_vector(spark, sf_dir):
    return [float(x) for x in scans.point_lookup(scans.read_table(spark, sf_dir, "embeddings"), "vec_id", 0).first().embedding]


DENSE = """dense AS (SELECT e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score
           FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)"""


@query(f"WITH {DENSE} SELECT id, score FROM dense ORDER BY score DESC, id LIMIT 20")
def r1_dense_topk(spark, sf_dir):
    return search.dense_topk(scans.read_table(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), 20, "vec_id", "embedding")


def _bm25_sql(source: str, key: str) -> str:
    terms = ", ".join(f"('{t}')" for t in TERMS.split())
    return rf"""tok AS (SELECT {key} AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM {source}),
tf AS (SELECT id, len(words) AS dl, term, len(list_filter(words, lambda x: x = term)) AS tf FROM tok, (VALUES {terms}) v(term)),
st AS (SELECT count(*) AS n, avg(len(words)) AS avgdl FROM tok), dfs AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM tf GROUP BY term),
bm AS (SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM tf JOIN dfs USING (term), st GROUP BY id HAVING sum(tf) > 0)"""


@query(f"WITH {_bm25_sql('documents', 'doc_id')} SELECT id, score FROM bm ORDER BY score DESC, id LIMIT 20")
def r2_bm25_topk(spark, sf_dir):
    return search.bm25_topk(scans.read_table(spark, sf_dir, "documents"), TERMS, 20, "doc_id", "text")


@query(f"WITH {_bm25_sql('documents', 'doc_id')} SELECT id, score FROM bm ORDER BY score DESC, id LIMIT 20")
def k2_stored_postings(spark, sf_dir):
    """BM25 from a collection's stored postings, behind an upsert that changes every second text."""
    docs = scans.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    collection = _collection(spark, "doc_id", text="text")
    collection.upsert(docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("the that of old "), "text")).otherwise(F.col("text"))))
    collection.upsert(docs.where("doc_id % 2 = 0"))
    found = postings.bm25_topk(collection.postings(), TERMS, 20)
    return _few(spark, collection, found.collect(), found.schema)


@query(f"WITH {DENSE} SELECT id, score FROM dense ORDER BY score DESC, id LIMIT 20")
def r7_index(spark, sf_dir):
    """Exact search by the bounds in a collection's vector index; tables of fewer rows than the index is for are scanned."""
    collection = _collection(spark, "vec_id", 1 << 14)
    collection.upsert(scans.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    VectorIndex.build(collection, "embedding")
    found = vector_topk(collection, _query_vector(spark, sf_dir), 20, "embedding", exact=True)
    return _few(spark, collection, found.collect(), found.schema)


@query(rf"""SELECT doc_id AS id, term, count(*) AS tf FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS term FROM documents) GROUP BY ALL""")
def r2_postings(spark, sf_dir):
    return search.postings(scans.read_table(spark, sf_dir, "documents"), "doc_id", "text").select("id", "term", "tf")


FUSED = """a AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM (SELECT * FROM bm ORDER BY score DESC, id LIMIT 20)),
b AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM (SELECT * FROM dense ORDER BY score DESC, id LIMIT 20)),
f AS (SELECT id, round(sum(1.0 / (60 + r)), 6) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id)"""


def _embedded(spark, sf_dir):
    docs = scans.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs.join(scans.read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), "id")


@query(f"WITH {DENSE}, {_bm25_sql('documents', 'doc_id')}, {FUSED} SELECT id, score FROM f ORDER BY score DESC, id LIMIT 10")
def r4_rrf(spark, sf_dir):
    lexical = search.bm25_topk(scans.read_table(spark, sf_dir, "documents"), TERMS, 20, "doc_id", "text")
    dense = search.dense_topk(scans.read_table(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), 20, "vec_id", "embedding")
    return search.rrf([lexical, dense], 10)


@query(f"""WITH both_ AS (SELECT doc_id, text FROM documents JOIN embeddings ON doc_id = vec_id), {DENSE.replace("FROM embeddings e", "FROM (SELECT * FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)) e")},
{_bm25_sql('both_', 'doc_id')}, {FUSED}
SELECT f.score, f.id, md5(left(text, 1800)) AS text_md5 FROM f JOIN both_ ON doc_id = f.id ORDER BY f.score DESC, f.id LIMIT 10""")
def r5_hybrid(spark, sf_dir):
    found = search.hybrid_search(_embedded(spark, sf_dir), TERMS, _query_vector(spark, sf_dir), 10, 20, 1800, "id", "embedding", "text")
    return found.select("score", "id", F.md5("text").alias("text_md5"))


LONGEST = 2500


def _measuring_embedder():
    """Characters and blanks of a text; over ``LONGEST`` characters it is too long."""

    def f(texts):
        if any(len(t) > LONGEST for t in texts):
            raise TooLong("too long")
        return [[len(t), t.count(" ")] for t in texts]

    return f


@query(f"""WITH RECURSIVE {_paragraph_sql(600)},
t AS (SELECT w.doc_id, w.chunk_index, string_agg(c.t, chr(10) || chr(10) ORDER BY c.i) AS text FROM walk w JOIN c ON c.doc_id = w.doc_id AND c.i BETWEEN w.i AND w.stop GROUP BY w.doc_id, w.chunk_index)
SELECT doc_id, chunk_index, CASE WHEN length(text) > {LONGEST} THEN 'too long' END AS skip_reason, CASE WHEN length(text) <= {LONGEST} THEN CAST(length(text) AS BIGINT) END AS characters,
       CASE WHEN length(text) <= {LONGEST} THEN CAST(length(text) - length(replace(text, ' ', '')) AS BIGINT) END AS blanks FROM t""")
def e3_embed(spark, sf_dir):
    """Requests sized by the document's passages; passages that are too long are skipped with a reason."""
    sized = _chunked(spark, sf_dir, 600).withColumn("texts", X.adaptive_batch("chunk_count"))
    out = embed(sized, "text", _measuring_embedder, 2, "texts")
    return out.select("doc_id", "chunk_index", "skip_reason", *(F.get("vector", F.lit(i)).cast("long").alias(c) for i, c in enumerate(("characters", "blanks"))))


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL""")
def w1_event_windows(spark, sf_dir):
    return loads.event_windows(scans.read_table(spark, sf_dir, "events"))
