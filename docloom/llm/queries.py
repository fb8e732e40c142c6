"""The registered queries ``opN_<name>``: each applies its operator to a whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import license_scan as licence
from docloom.llm import pii, scratch, warc
from docloom.llm.ann import nearest
from docloom.llm.encoding import decode, encode
from docloom.llm.jaccard import jaccard_components
from docloom.llm.line_dedup import line_dedup
from docloom.llm.packing import pack
from docloom.llm.spelling import LETTERS, count_words, variant_groups
from docloom.llm.topk import top_k
from docloom.llm.toxicity import fit, held_out, score
from docloom.llm.turns import repair, report
from docloom.llm.url_filter import LISTED_WORDS, RULES, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.annotate(docs, pii.fit(docs))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told("base").cast("binary"), 256).alias("base_sha256"), told("spans").alias("spans"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


OP3 = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(least(w.doc_id, min(r.y)), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = w.doc_id GROUP BY w.doc_id
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), least_words=1)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, lines = licence.known_table(spark, licence.LICENCES), spark.createDataFrame([(v, k) for k, v in licence.NOTICES.items()], "licence string, text string")
    found = licence.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), whole, lines)
    return found.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


def _canonical_sql(text: str) -> str:
    plain = f"trim(regexp_replace(lower(regexp_replace({text}, '{licence.COPYRIGHT}', chr(10), 'g')), '{licence.OTHER}', ' ', 'g'), ' ')"
    for one, other in licence.SPELLINGS.items():
        plain = rf"regexp_replace({plain}, '\b{one}\b', '{other}', 'g')"
    return plain


def _known_sql(rows: list[tuple[str, str]]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in rows)
    return f"(SELECT md5({_canonical_sql('text')}) AS digest, min(licence) AS licence FROM (VALUES {values}) t(licence, text) GROUP BY 1)"


OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, md5({_canonical_sql("text")}) AS digest FROM d),
l AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT doc_id, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS notices
      FROM (SELECT doc_id, md5({_canonical_sql("line")}) AS digest FROM l) x JOIN {_known_sql([(v, k) for k, v in licence.NOTICES.items()])} k USING (digest) GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.licence, coalesce(n.notices, '') AS notices
FROM w LEFT JOIN {_known_sql(sorted(licence.LICENCES.items()))} k USING (digest) LEFT JOIN n USING (doc_id)
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


OP6 = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
f AS (SELECT h.page_id, h.host, h.path, r.rhost || r.rpath AS rule, r.verdict,
             row_number() OVER (PARTITION BY h.page_id, h.host, h.path ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS n
      FROM h LEFT JOIN r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM f WHERE n = 1
"""


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents"), ranks).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    back = decode(coded, ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, k=20)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""



def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults of known kinds; ``copies`` is how many times a turn then stands there."""
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    told = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    turns = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(told.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def _crc32_sql(codes: str) -> str:
    """The CRC-32 of a list of bytes."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, {table}[CAST(xor(c, b) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(repair(damaged(table(spark, sf_dir, "conversations")), F.col("copies")))


def _op11_sql() -> str:
    """The same edits by another way: the least cost and letters up to every turn, from the front alone."""
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    moved = lambda v, cost, letter, told="''": f"{{'c': {v}.c + {cost}, 'a': {v}.a || '{letter}', 't': {v}.t || {told}}}"
    where = lambda test, x: f"CASE WHEN {test} THEN {x} ELSE {{'c': 1000000000, 'a': '', 't': ''}} END"
    into = {"u": "'\n' || 'user:'", "a": "'\n' || 'assistant:'"}
    sound = "fault NOT IN ('blank', 'duplicate')"
    more = "CASE fault WHEN 'truncated' THEN 3 ELSE 0 END"
    keep = lambda v, initial: where(f"{sound} AND ini = '{initial}'", moved(v, more, "K", "'\n' || role || ':' || text"))
    role = lambda v, initial: where(sound, moved(v, f"3 + {more}", "R", f"{into[initial]} || text"))
    settled = f"""SELECT * REPLACE ({least("w4", moved("w3", 3, "I", into["a"]))} AS w4)
        FROM (SELECT * REPLACE ({least("w3", *(moved(v, 3, "I", into["u"]) for v in ("w1", "w2", "w4")))} AS w3) FROM"""
    none = "{'c': 1000000000, 'a': '', 't': ''}"
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(unicode(x) AS BIGINT))")} % 20 AS f FROM conversations),
d AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d),
m AS (SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
             WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
j AS (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS last FROM m),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND last || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS turns FROM j GROUP BY conv_id),
w(conv_id, i, w1, w2, w3, w4) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {{'c': 0, 'a': '', 't': ''}}, {none}, {none}, {none} FROM conversations
    UNION ALL SELECT conv_id, i, {moved("w1", 4, "D")}, {least(moved("w2", 4, "D"), keep("w1", "s"))},
        {least(moved("w3", 4, "D"), *(f(v, "u") for f in (keep, role) for v in ("w1", "w2", "w4")))}, {least(moved("w4", 4, "D"), keep("w3", "a"), role("w3", "a"))}
    FROM ({settled} (SELECT w.conv_id, m.i, w1, w2, w3, w4, m.role, m.text, m.ini, m.fault FROM w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1)))),
e AS (SELECT conv_id, i, {least("w1", "w4")} AS x FROM ({settled} w)))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(x.c AS BIGINT) AS cost, x.a AS audit, sha256(substr(x.t, 2)) AS repaired_sha256
FROM e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(n.turns, 0)
""".replace("'\n'", "chr(10)")


OP11 = _op11_sql()


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(count_words(table(spark, sf_dir, "documents")))


_UTF8 = "flatten(list_transform(string_split(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (CAST(unicode(x) AS BIGINT) >> 6), 128 + (CAST(unicode(x) AS BIGINT) & 63)] END))"
OP12 = f"""
WITH RECURSIVE r AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{LETTERS}]{{6,}}')) AS run FROM documents) GROUP BY doc_id, run),
h AS (SELECT run, times, {_crc32_sql(_UTF8)} AS h FROM r),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
c AS (SELECT word, n, i, left(word, i - 1) AS front, substr(word, i + 1) AS back FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM c a JOIN c b ON a.i = b.i AND a.front = b.front AND a.back = b.back AND a.word <> b.word
      UNION SELECT c.word, w.word, w.n FROM c JOIN w ON w.word = c.front || c.back
      UNION SELECT w.word, c.word, c.n FROM c JOIN w ON w.word = c.front || c.back),
b AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM w LEFT JOIN b USING (word)),
g AS (SELECT word, word AS root, form FROM f UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON f.word = g.form)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN g ON g.word = f.word AND g.form IS NULL
"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch.folder(spark)}/docloom-{uuid.uuid4().hex}"
    with scratch.scope() as leave:
        found = warc.read(warc.write(table(spark, sf_dir, "pages"), folder))
        number = lambda c: F.col(c).cast("long")
        told = leave(scratch.keep(found.select(number("record").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))))
    scratch.remove(spark, folder)
    return told


_BITS = "CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT)"
OP13 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url) AS n,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages),
d AS (SELECT *, sha1(html) AS h FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(flatten(list_transform(range(8), lambda i: list_transform([15, 10, 5, 0], lambda s: ({_BITS} >> s) & 31))), lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1)), '') AS payload_digest,
       CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN best END AS refers_to
FROM d
"""


QUERIES = {
    "op1_pack": op1_pack,
    "op2_pii": op2_pii,
    "op3_jaccard": op3_jaccard,
    "op4_line_dedup": op4_line_dedup,
    "op5_license": op5_license,
    "op6_url_filter": op6_url_filter,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_nearest": op9_nearest,
    "op10_top_k": op10_top_k,
    "op11_conversations": op11_conversations,
    "op12_spelling": op12_spelling,
    "op13_warc": op13_warc,
}
ORACLES = {"op3_jaccard": OP3, "op5_license": OP5, "op6_url_filter": OP6, "op10_top_k": OP10, "op11_conversations": OP11, "op12_spelling": OP12, "op13_warc": OP13}
