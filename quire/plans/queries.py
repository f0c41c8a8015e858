"""One query per operator over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assemble as A
from ..operators import document as D
from ..operators import ocr
from ..operators import raster as R
from ..sources import files
from ..storage import Table, application_folder
from ..streaming import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


ID_SQL = "(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12))"
STRIP_SQL = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
NAMES = "b.PDF,a.md,x.tar.gz,c.xlsx,d.XLS,e.docx,f.txt,g.png,h.JPEG,noext,.hidden,i.csv,j.webp,k.tif,l.svg"


@query(f"""
WITH n AS (SELECT doc_id, 'in/' || string_split('{NAMES}', ',')[(doc_id % 15 + 1)::INT] AS path FROM documents),
e AS (SELECT doc_id, lower(regexp_extract(string_split(path, '/')[-1], '^.+(\\.[^.]+)$', 1)) AS ext FROM n)
SELECT doc_id, ext, CASE WHEN ext IN ('.jpg', '.jpeg', '.png', '.gif', '.webp', '.bmp', '.tiff', '.tif') THEN 'rejected_image'
 WHEN ext IN ('.xlsx', '.xls') THEN 'excel' WHEN ext = '.pdf' THEN 'pdf' WHEN ext = '.docx' THEN 'docx'
 WHEN ext IN ('.txt', '.md') THEN 'text' ELSE 'unsupported' END AS kind FROM e""")
def route_files(spark, sf):
    path = F.concat(F.lit("in/"), F.element_at(F.split(F.lit(NAMES), ","), (F.col("doc_id") % 15 + 1).cast("int")))
    return read(spark, sf, "documents").select("doc_id", T.extension(path).alias("ext")).withColumn("kind", T.route(F.col("ext")))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace('NaN ' || text || ' Unnamed: ' || doc_id::VARCHAR || ' NaN end', 'Unnamed:\s*\d+', '', 'g'), '\bNaN\b', '', 'g') AS text FROM documents""")
def clean_text(spark, sf):
    t = F.concat(F.lit("NaN "), "text", F.lit(" Unnamed: "), F.col("doc_id").cast("string"), F.lit(" NaN end"))
    return read(spark, sf, "documents").select("doc_id", T.clean_text(t).alias("text"))


@query(f"""
WITH t AS (SELECT conv_id, string_agg('## ' || role || chr(10) || text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, list_transform(list_filter(string_split(chr(10) || t, chr(10) || '## '), lambda x, i: i > 1), lambda x: {STRIP_SQL.format("('## ' || x)")}) AS parts FROM t)
SELECT conv_id, (unnest(range(len(parts))))::INT AS sheet_no, unnest(parts) AS text FROM s""")
def split_sheets(spark, sf):
    rows = read(spark, sf, "conversations").withColumn("text", F.concat(F.lit("## "), "role", F.lit("\n"), "text"))
    whole = A.pages(rows.withColumn("text", F.concat("text", F.lit("\n"))), ("conv_id",), "turn")
    return whole.select("conv_id", F.posexplode(T.split_sheets(F.col("text"))).alias("sheet_no", "text"))


def _lines(spark, sf) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block_no", "line"))


LINES_SQL = "SELECT doc_id, (unnest(range(len(ls))))::INT AS block_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"
NORMAL_SQL = r"trim(regexp_replace(line, '\s+', ' ', 'g')) || chr(10)"


@query(f"SELECT doc_id, block_no, {NORMAL_SQL} AS text FROM ({LINES_SQL})")
def block_normalize(spark, sf):
    spans = F.array(F.struct(F.array(F.struct(F.col("line").alias("text"))).alias("spans")))
    return _lines(spark, sf).select("doc_id", "block_no", T.block_line(T.spans_text(spans)).alias("text"))


@query(f"SELECT doc_id, string_agg({NORMAL_SQL}, '' ORDER BY block_no) AS text FROM ({LINES_SQL}) GROUP BY doc_id")
def page_assemble(spark, sf):
    return A.pages(_lines(spark, sf).select("doc_id", "block_no", T.block_line(F.col("line")).alias("text")), ("doc_id",))


@query("SELECT conv_id, string_agg(text || chr(10), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def doc_assemble(spark, sf):
    return A.documents(read(spark, sf, "conversations").withColumn("text", F.concat("text", F.lit("\n"))), "conv_id", "turn")


@query("""
WITH p AS (SELECT conv_id, list(text ORDER BY turn) AS ts FROM conversations GROUP BY conv_id),
n AS (SELECT conv_id, ts, unnest([-1, 0, 1, 99])::INT AS n FROM p)
SELECT conv_id, n, CASE WHEN n >= 0 AND n < len(ts) THEN ts[n + 1] ELSE '' END AS text FROM n""")
def page_lookup(spark, sf):
    pages = read(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda p: p["text"]).alias("pages"))
    return pages.select("conv_id", "pages", F.explode(F.array(*map(F.lit, (-1, 0, 1, 99)))).alias("n")).select("conv_id", "n", T.page_at(F.col("pages"), F.col("n")).alias("text"))


@query(f"SELECT doc_id, 'Image-Placeholder{{' || {ID_SQL} || '}}' || chr(10) AS text FROM (SELECT doc_id, md5(doc_id || '/0/1') AS h FROM documents)")
def placeholder_emit(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.placeholder(T.image_id(F.col("doc_id"), F.lit(0), F.lit(1))).alias("text"))


def _marked(spark, sf) -> DataFrame:
    i = T.image_id(F.col("doc_id"), F.lit(0), F.lit(1))
    return read(spark, sf, "documents").select("doc_id", i.alias("image_id"), F.concat("text", F.lit("\n"), T.placeholder(i), F.lit("tail")).alias("text"))


@query(f"SELECT doc_id, {ID_SQL} AS image_id FROM (SELECT doc_id, md5(doc_id || '/0/1') AS h FROM documents)")
def placeholder_extract(spark, sf):
    return _marked(spark, sf).select("doc_id", F.explode(T.placeholder_ids(F.col("text"))).alias("image_id"))


def _replies(spark, sf) -> DataFrame:
    """A reply for documents in all languages but one: its source and language."""
    d = read(spark, sf, "documents").where("lang <> 'fr'")
    return d.select(T.image_id(F.col("doc_id"), F.lit(0), F.lit(1)).alias("image_id"), F.concat(F.lit(" "), "source", F.lit(" "), "lang", F.lit("\n")).alias("content"))


@query("SELECT doc_id, CASE WHEN lang <> 'fr' THEN source || ' ' || lang ELSE '' END || chr(10) AS text FROM documents")
def placeholder_join(spark, sf):
    blocks = _marked(spark, sf).select("doc_id", "image_id", F.lit("").alias("text"))
    return A.with_replies(blocks, _replies(spark, sf)).select("doc_id", "text")


@query("SELECT doc_id, text || chr(10) || CASE WHEN lang <> 'fr' THEN source || ' ' || lang ELSE '' END || chr(10) || 'tail' AS text FROM documents")
def placeholder_splice(spark, sf):
    m = _marked(spark, sf).join(_replies(spark, sf), "image_id", "left")
    replies = F.when(F.col("content").isNull(), F.create_map().cast("map<string,string>")).otherwise(F.create_map("image_id", "content"))
    return m.select("doc_id", T.splice(F.col("text"), replies).alias("text"))


@query(f"SELECT conv_id, {ID_SQL} AS image_id, {STRIP_SQL.format('text')} AS content FROM (SELECT conv_id, text, md5(conv_id || '/' || turn) AS h FROM conversations)")
def parse_reply(spark, sf):
    c = read(spark, sf, "conversations").withColumn("i", T.image_id(F.col("conv_id"), F.col("turn")))
    c = c.withColumn("text", F.concat(F.lit("<"), "i", F.lit(">\n"), "text", F.lit("\n</"), "i", F.lit(">\n")))
    return A.pages(c, ("conv_id",), "turn").select("conv_id", F.explode(T.segments(F.col("text"))).alias("s")).select("conv_id", F.col("s.id").alias("image_id"), "s.content")


@query("SELECT user_id, arg_max(event_type, event_id) AS content FROM events GROUP BY user_id")
def reply_last_wins(spark, sf):
    return A.last_wins(read(spark, sf, "events").withColumnRenamed("event_type", "content"), "user_id", "content", "event_id")


@query("SELECT user_id, arg_max(value, event_id) AS content FROM events GROUP BY user_id")
def merge_last_wins(spark, sf):
    e = read(spark, sf, "events").select("user_id", F.col("value").alias("content"), "event_id")
    return A.last_wins(e.where("event_id % 2 = 0").unionByName(e.where("event_id % 2 = 1")), "user_id", "content", "event_id")


@query(f"SELECT doc_id, '{T.NO_CONTENT}' AS content FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_ids(spark, sf):
    return A.missing(read(spark, sf, "documents"), read(spark, sf, "labels"), "doc_id", T.NO_CONTENT)


@query(f"SELECT doc_id, '{T.SKIPPED}' AS content FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def skipped_ids(spark, sf):
    return A.missing(read(spark, sf, "documents"), read(spark, sf, "labels").where("quality = 1"), "doc_id", T.SKIPPED)


@query(r"SELECT doc_id, i AS image_id, (regexp_replace(i, '\s+', '', 'g') <> '' AND NOT contains(i, ']') AND NOT contains(i, chr(10))) AS is_valid FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '  ' WHEN 1 THEN source || ']' WHEN 2 THEN text ELSE source END AS i FROM documents)")
def validate_ids(spark, sf):
    k = F.col("doc_id") % 5
    i = F.when(k == 0, "  ").when(k == 1, F.concat("source", F.lit("]"))).when(k == 2, F.col("text")).otherwise(F.col("source"))
    return read(spark, sf, "documents").select("doc_id", i.alias("image_id")).withColumn("is_valid", T.valid_id(F.col("image_id")))


BATCH_SQL = "SELECT *, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2)::INT AS batch_no, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) % 2 + 1)::INT AS place FROM conversations"


@query(f"SELECT conv_id, turn, batch_no, place FROM ({BATCH_SQL})")
def image_batches(spark, sf):
    return A.batches(read(spark, sf, "conversations").select("conv_id", "turn"), 2, "conv_id", ("turn",)).select("conv_id", "turn", "batch_no", "place")


def _batches(spark, sf) -> DataFrame:
    """A conversation's turns as its images, two a batch."""
    b = A.batches(read(spark, sf, "conversations"), 2, "conv_id", ("turn",))
    part = F.struct("place", T.image_id(F.col("conv_id"), F.col("turn")).alias("image_id"), F.lit("image/png").alias("media_type"), T.base64_text(F.encode("text", "UTF-8")).alias("b64"))
    return b.groupBy("conv_id", "batch_no").agg(F.array_sort(F.collect_list(part)).alias("parts"))


def _parts(spark, sf, form: str) -> DataFrame:
    rows = _batches(spark, sf).select("conv_id", "batch_no", F.posexplode(A.prompt_parts(F.col("parts"), "Read.", form)).alias("part_no", "p"))
    return rows.select("conv_id", "batch_no", "part_no", "p.type", "p.text", "p.url", "p.data")


TURN_SQL = f"SELECT *, {ID_SQL} AS i FROM (SELECT *, md5(conv_id || '/' || turn) AS h FROM ({BATCH_SQL}))"


@query(f"""
WITH b AS ({TURN_SQL})
SELECT DISTINCT conv_id, batch_no, 0::INT AS part_no, 'text' AS type, 'Read.' AS text, NULL::VARCHAR AS url, NULL::VARCHAR AS data FROM b
UNION ALL SELECT conv_id, batch_no, (2 * place - 1)::INT, 'text', '[ID: ' || i || ']' || chr(10), NULL, NULL FROM b
UNION ALL SELECT conv_id, batch_no, (2 * place)::INT, 'image_url', NULL, 'data:image/png;base64,' || base64(encode(text)), NULL FROM b""")
def prompt_parts(spark, sf):
    return _parts(spark, sf, "url")


@query(f"""
WITH b AS ({TURN_SQL})
SELECT DISTINCT conv_id, batch_no, 0::INT AS part_no, 'text' AS type, 'Read.' AS text, NULL::VARCHAR AS url, NULL::VARCHAR AS data FROM b
UNION ALL SELECT conv_id, batch_no, (3 * place - 2)::INT, 'text', '<file image_id="' || i || '">' || chr(10), NULL, NULL FROM b
UNION ALL SELECT conv_id, batch_no, (3 * place - 1)::INT, 'image', NULL, NULL, base64(encode(text)) FROM b
UNION ALL SELECT conv_id, batch_no, (3 * place)::INT, 'text', chr(10) || '</file image_id="' || i || '">' || chr(10) || chr(10), NULL, NULL FROM b""")
def prompt_source(spark, sf):
    return _parts(spark, sf, "source")


@query(f"""
WITH b AS ({TURN_SQL})
SELECT conv_id, batch_no, (2 * place - 2)::INT AS part_no, 'text' AS type, 'Image ' || place || '. Image ID: ' || i AS text, NULL::VARCHAR AS url, NULL::VARCHAR AS data FROM b
UNION ALL SELECT conv_id, batch_no, (2 * place - 1)::INT, 'image', NULL, NULL, base64(encode(text)) FROM b
UNION ALL SELECT conv_id, batch_no, (2 * max(place))::INT, 'text', 'Read.', NULL, NULL FROM b GROUP BY conv_id, batch_no""")
def prompt_enumerate(spark, sf):
    return _parts(spark, sf, "numbered")


class TurnClient:
    """Stands for a model: reads each image's text, gives a wrong one first, leaves out texts with a question mark, fails on a batch with "error"."""

    def invoke(self, parts):
        out, current = ["<00000000-0000-0000-0000-000000000000>nobody asked</00000000-0000-0000-0000-000000000000>"], ""
        for p in ocr.message(parts):
            if p["type"] == "text":
                current = p["text"][5:-2]
            else:
                text = base64.b64decode(p["image_url"]["url"].split(",", 1)[1]).decode()
                if len(text) % 11 == 0:
                    raise ValueError("cannot read this")
                if len(text) % 7:
                    out.append(f"<{current}>wrong</{current}><{current}>\n{text}\n</{current}>")
        return "\n".join(out), len(parts), len(out)


def _calls(spark, sf) -> DataFrame:
    rows = _batches(spark, sf).withColumnRenamed("conv_id", "doc_id").select("doc_id", "batch_no", F.transform("parts", lambda p: p["image_id"]).alias("ids"), A.prompt_parts(F.col("parts"), "Read.").alias("parts"))
    return Table(spark, ocr.call(rows, TurnClient, wait=0)).df


@query(f"""
WITH b AS (SELECT *, bool_or(length(text) % 11 = 0) OVER (PARTITION BY conv_id, batch_no) AS failed FROM ({TURN_SQL}))
SELECT conv_id AS doc_id, batch_no, i AS image_id, CASE WHEN failed THEN '{T.API_ERROR % "cannot read this"}' WHEN length(text) % 7 = 0 THEN '{T.NO_CONTENT}' ELSE {STRIP_SQL.format('text')} END AS content,
 CASE WHEN failed THEN 'api_error' WHEN length(text) % 7 = 0 THEN 'no_content' ELSE 'ok' END AS status FROM b""")
def ocr_replies(spark, sf):
    return ocr.parse(_calls(spark, sf))


@query(f"""
WITH b AS (SELECT conv_id, batch_no, count(*) AS n, count(*) FILTER (WHERE length(text) % 7 <> 0) AS k, bool_or(length(text) % 11 = 0) AS failed FROM ({BATCH_SQL}) GROUP BY conv_id, batch_no)
SELECT conv_id AS doc_id, count(*) AS calls, sum(CASE WHEN failed THEN 0 ELSE 1 + 2 * n END)::BIGINT AS token_input, sum(CASE WHEN failed THEN 0 ELSE 1 + k END)::BIGINT AS token_output FROM b GROUP BY conv_id""")
def usage_rollup(spark, sf):
    return ocr.usage(_calls(spark, sf)).drop("elapsed_time")


MODES = "L,RGB,RGBA,LA,P"


@query(f"SELECT doc_id, CASE WHEN m IN ('RGBA', 'LA', 'P') THEN 'image/png' ELSE 'image/jpeg' END AS media_type FROM (SELECT doc_id, string_split('{MODES}', ',')[(doc_id % 5 + 1)::INT] AS m FROM documents)")
def media_type(spark, sf):
    mode = F.element_at(F.split(F.lit(MODES), ","), (F.col("doc_id") % 5 + 1).cast("int"))
    return read(spark, sf, "documents").select("doc_id", T.media_type(mode).alias("media_type"))


@query("SELECT doc_id, base64(encode(text)) AS b64 FROM documents")
def base64_payload(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.base64_text(F.encode("text", "UTF-8")).alias("b64"))


@query("SELECT doc_id, greatest(1, round(w * s)::INT) AS width, greatest(1, round(h * s)::INT) AS height FROM (SELECT *, least(1.0::DOUBLE, 2048.0::DOUBLE / w, 2048.0::DOUBLE / h) AS s FROM (SELECT doc_id, 1 + (doc_id * 37) % 5000 AS w, 1 + (doc_id * 91) % 3000 AS h FROM documents))")
def bounded_size(spark, sf):
    d = read(spark, sf, "documents").selectExpr("doc_id", "1 + (doc_id * 37) % 5000 AS w", "1 + (doc_id * 91) % 3000 AS h")
    return d.select("doc_id", T.thumbnail_size(F.col("w"), F.col("h")).alias("s")).select("doc_id", "s.width", "s.height")


@query("SELECT doc_id, greatest(1, floor(w * s)::INT) AS width, greatest(1, floor(h * s)::INT) AS height FROM (SELECT *, least(224.0::DOUBLE / w, 224.0::DOUBLE / h) AS s FROM (SELECT doc_id, 1 + (doc_id * 37) % 5000 AS w, 1 + (doc_id * 91) % 3000 AS h FROM documents))")
def letterbox_size(spark, sf):
    d = read(spark, sf, "documents").selectExpr("doc_id", "1 + (doc_id * 37) % 5000 AS w", "1 + (doc_id * 91) % 3000 AS h")
    return d.select("doc_id", T.letterbox(F.col("w"), F.col("h")).alias("s")).select("doc_id", "s.width", "s.height")


@query("SELECT md5(text) AS dhash, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedup_first(spark, sf):
    return A.first_seen(read(spark, sf, "documents").select(F.md5("text").alias("dhash"), "doc_id"), "dhash", ("doc_id",))


@query("SELECT doc_id, md5(text) AS dhash FROM documents WHERE doc_id % 2 = 1 AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0)")
def dedup_incremental(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", F.md5("text").alias("dhash"))
    return A.unseen(d.where("doc_id % 2 = 1"), d.where("doc_id % 2 = 0").distinct(), "dhash").select("doc_id", "dhash")


@query("SELECT doc_id FROM documents WHERE 1 + (doc_id * 37) % 100 >= 32 AND 1 + (doc_id * 91) % 100 >= 32")
def min_dimensions(spark, sf):
    d = read(spark, sf, "documents").selectExpr("doc_id", "1 + (doc_id * 37) % 100 AS width", "1 + (doc_id * 91) % 100 AS height")
    return d.where((F.col("width") >= R.MIN_SIDE) & (F.col("height") >= R.MIN_SIDE)).select("doc_id")


SIDE = 64
PIXEL = f"(31 * id + 7 * x * x + 13 * y * (1 + id % 3)) % (40 + 8 * (id % 25))"


def _images(spark, sf) -> DataFrame:
    """A gray raster for each supplier, as plain bytes."""
    places = F.expr(f"transform(sequence(0, {SIDE * SIDE - 1}), p -> lpad(hex({PIXEL.replace('x', '(p % 64)').replace('y', '(p div 64)')}), 2, '0'))")
    ids = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("id"))
    ids = ids.repartition(spark.sparkContext.defaultParallelism)  # the table is one small file, the images are not
    return ids.select(F.col("id").cast("string").alias("image_id"), F.unhex(F.array_join(places, "")).alias("bytes"))


def plain_gray(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(SIDE, SIDE)


def taps(n_in: int, n_out: int, name: str) -> str:
    """SQL of the weights with which n_in pixels make n_out: o, i, k."""
    s, w = n_in / n_out, max(n_in / n_out, 1.0)
    sinc = lambda x: f"CASE WHEN {x} = 0 THEN 1.0 ELSE sin(pi() * {x}) / (pi() * {x}) END"
    return f"""
{name}0 AS (SELECT o, i, (o + 0.5::DOUBLE) * {s!r}::DOUBLE AS c FROM range({n_out}) a(o), range({n_in}) b(i)),
{name}1 AS (SELECT o, i, (i - c + 0.5::DOUBLE) / {w!r}::DOUBLE AS x FROM {name}0 WHERE i >= greatest(floor(c - {3 * w!r}::DOUBLE + 0.5), 0) AND i < least(floor(c + {3 * w!r}::DOUBLE + 0.5), {n_in})),
{name}2 AS (SELECT o, i, CASE WHEN abs(x) < 3 THEN ({sinc('x')}) * ({sinc('(x / 3)')}) ELSE 0.0 END AS v FROM {name}1),
{name} AS (SELECT o, i, floor(v / sum(v) OVER (PARTITION BY o) * {1 << R.BITS} + 0.5)::BIGINT AS k FROM {name}2)"""


def resized(width: int, height: int, name: str) -> str:
    """SQL of the pixels px (id, x, y, v) at another size, as {name} (id, x, y, v)."""
    byte = f"greatest(0, least(255, (sum(v * k) + {1 << (R.BITS - 1)})::BIGINT >> {R.BITS}))"
    return f"""
{taps(SIDE, width, name + "_w")}, {taps(SIDE, height, name + "_h")},
{name}_a AS (SELECT id, o AS x, y, {byte} AS v FROM px JOIN {name}_w ON x = i GROUP BY id, o, y),
{name} AS (SELECT id, x, o AS y, {byte} AS v FROM {name}_a JOIN {name}_h ON y = i GROUP BY id, x, o)"""


PIXELS_SQL = f"SELECT id, x, y, ({PIXEL})::INT AS v FROM (SELECT s_suppkey::BIGINT AS id, x, y FROM supplier, range({SIDE}) a(x), range({SIDE}) b(y))"
METRICS_SQL = f"""
px AS ({PIXELS_SQL}), {resized(100, 100, "big")},
h AS (SELECT id, v, count(*) AS n FROM px GROUP BY id, v),
e AS (SELECT id, least(-sum(n / 4096.0::DOUBLE * log2(n / 4096.0::DOUBLE)) / 8, 1.0) AS entropy, least(count(*) / 500.0::DOUBLE, 1.0) AS color FROM h GROUP BY id),
u AS (SELECT id, least(count(DISTINCT v) / 500.0::DOUBLE, 1.0) AS uniqueness FROM big GROUP BY id),
b AS (SELECT id, avg(v) AS mean, least(stddev_pop(v) / 40, 1.0) AS variance FROM px GROUP BY id),
w1 AS (SELECT *, lag(v) OVER r + lead(v) OVER r AS lr, lag(v) OVER c + lead(v) OVER c AS ud FROM px WINDOW r AS (PARTITION BY id, y ORDER BY x), c AS (PARTITION BY id, x ORDER BY y)),
w2 AS (SELECT *, lr + ud AS straight, lag(lr) OVER c + lead(lr) OVER c AS diag FROM w1 WINDOW c AS (PARTITION BY id, x ORDER BY y)),
k AS (SELECT id, coalesce(greatest(0, least(255, 8 * v - straight - diag)), v) AS e, coalesce(greatest(0, least(255, straight - 4 * v)), v) AS l, straight IS NULL OR diag IS NULL AS edge, v FROM w2),
k2 AS (SELECT id, sum(CASE WHEN edge THEN v ELSE e END) / 255.0::DOUBLE / 4096 AS ratio, least(var_pop(CASE WHEN edge THEN v ELSE l END) / 300, 1.0) AS texture FROM k GROUP BY id),
g AS (SELECT id, least(var_pop(cv) / 500, 1.0) AS density FROM (SELECT id, x // 16, y // 16, var_pop(v) AS cv FROM px GROUP BY ALL) GROUP BY id),
m AS (SELECT id, CASE WHEN mean > 30 AND mean < 230 THEN 1.0 WHEN mean >= 245 OR mean <= 15 THEN 0.0 WHEN mean >= 230 THEN (245 - mean) / 15 ELSE (mean - 15) / 15 END::DOUBLE AS brightness,
 color, entropy, CASE WHEN ratio < 0.03 THEN ratio / 0.03 WHEN ratio > 0.10 THEN 1.0 ELSE 0.5 + (ratio - 0.03) / 0.14 END::DOUBLE AS edges, variance, uniqueness, texture, density
 FROM e JOIN u USING (id) JOIN b USING (id) JOIN k2 USING (id) JOIN g USING (id)),
t AS (SELECT *, 0.15 * brightness + 0.10 * color + 0.15 * entropy + 0.20 * edges + 0.05 * variance + 0.05 * uniqueness + 0.10 * texture + 0.20 * density AS total_score FROM m)
"""
HASH_SQL = f"""
px AS ({PIXELS_SQL}), {resized(9, 8, "small")},
bits AS (SELECT id, y, x, CASE WHEN lead(v) OVER (PARTITION BY id, y ORDER BY x) > v THEN 1 ELSE 0 END AS bit FROM small),
dh AS (SELECT id, string_agg(hex, '' ORDER BY place) AS dhash FROM (SELECT id, 2 * y + x // 4 AS place, lower(substr('0123456789ABCDEF', (sum(bit << (3 - x % 4)) + 1)::INT, 1)) AS hex FROM bits WHERE x < 8 GROUP BY id, y, x // 4) GROUP BY id)
"""


def _scored(spark, sf) -> DataFrame:
    return R.score(_images(spark, sf), plain_gray)


def _metric_query(name: str, *columns: str) -> None:
    QUERIES[name] = lambda spark, sf: _scored(spark, sf).select(F.col("image_id").cast("long").alias("id"), *[F.round(c, 6).alias(c) for c in columns])
    SQL[name] = f"WITH {METRICS_SQL} SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in columns) + " FROM t"


@query(f"SELECT id, v, count(*) AS n FROM ({PIXELS_SQL}) GROUP BY id, v")
def histogram(spark, sf):
    px = _images(spark, sf).select(F.col("image_id").cast("long").alias("id"), F.explode(F.sequence(F.lit(1), F.length("bytes"))).alias("p"), "bytes")
    return px.select("id", F.conv(F.hex(F.substring("bytes", F.col("p"), F.lit(1))), 16, 10).cast("int").alias("v")).groupBy("id", "v").agg(F.count("*").alias("n"))


_metric_query("entropy", "entropy")
_metric_query("brightness", "brightness")
_metric_query("color_diversity", "color")
_metric_query("variance", "variance")
_metric_query("unique_colors", "uniqueness")
_metric_query("edge_density", "edges")
_metric_query("texture", "texture")
_metric_query("grid_density", "density")
_metric_query("weighted_score", "total_score")


@query(f"WITH {HASH_SQL} SELECT id, dhash FROM dh")
def perceptual_hash(spark, sf):
    return _scored(spark, sf).select(F.col("image_id").cast("long").alias("id"), "dhash")


@query(f"WITH {METRICS_SQL} SELECT id FROM t WHERE total_score >= 0.5")
def score_filter(spark, sf):
    return R.meaningful(_scored(spark, sf), ("image_id",), dedup=False).select(F.col("image_id").cast("long").alias("id"))


@query(f"""WITH {METRICS_SQL}, {HASH_SQL.replace("px AS (" + PIXELS_SQL + "),", "")},
f AS (SELECT id, row_number() OVER (PARTITION BY dhash ORDER BY id::VARCHAR) AS n FROM dh)
SELECT id FROM t JOIN f USING (id) WHERE n = 1 AND total_score >= 0.5""")
def image_filter(spark, sf):
    return R.meaningful(_scored(spark, sf), ("image_id",)).select(F.col("image_id").cast("long").alias("id"))


@query(f"WITH {METRICS_SQL} SELECT count(*) AS n_images, count(*) FILTER (WHERE total_score >= 0.5) AS n_kept FROM t")
def filter_stats(spark, sf):
    images, kept = _images(spark, sf).select("image_id"), R.meaningful(_scored(spark, sf), ("image_id",), dedup=False).select("image_id")
    both = images.select(F.lit(0).alias("kept")).unionByName(kept.select(F.lit(1).alias("kept")))
    return both.agg(F.count(F.when(F.col("kept") == 0, 1)).alias("n_images"), F.count(F.when(F.col("kept") == 1, 1)).alias("n_kept"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x: x >= 0.35)) > 0 AS has_text FROM embeddings")
def text_presence(spark, sf):
    return read(spark, sf, "embeddings").select("vec_id", R.confident(F.col("embedding"), 0.35).alias("has_text"))


@query(f"SELECT doc_id, {STRIP_SQL.format('text')} AS text FROM documents")
def local_ocr_lines(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text"), F.lit(0.9).alias("confidence")))
    return read(spark, sf, "documents").select("doc_id", T.line_texts(lines).alias("text"))


@query("SELECT DISTINCT md5(text) AS dhash FROM documents")
def stream_dedup(spark, sf):
    at = f"{application_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = read(spark, sf, "documents").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/documents.parquet*")
    out = S.dedup(rows.select(F.md5("text").alias("dhash")), "dhash")
    out.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").option("path", f"{at}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{at}/out")


def document_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of every document and an image block at its end, the images' replies, splice, pages, documents."""
    lines = _lines(spark, sf).select("doc_id", F.lit(0).alias("page_no"), "block_no", F.lit(None).cast("string").alias("image_id"), T.block_line(F.col("line")).alias("text"))
    images = read(spark, sf, "documents").select("doc_id", F.lit(0).alias("page_no"), F.lit(2**31 - 1).alias("block_no"), T.image_id(F.col("doc_id"), F.lit(0), F.lit(1)).alias("image_id"), F.lit("").alias("text"))
    return A.documents(A.pages(A.with_replies(lines.unionByName(images), _replies(spark, sf))))


QUERIES["document_pipeline"] = document_pipeline
SQL["document_pipeline"] = f"""
WITH p AS (SELECT doc_id, string_agg({NORMAL_SQL}, '' ORDER BY block_no) AS t FROM ({LINES_SQL}) GROUP BY doc_id)
SELECT doc_id, t || CASE WHEN lang <> 'fr' THEN source || ' ' || lang ELSE '' END || chr(10) AS text FROM p JOIN documents USING (doc_id)"""


class EchoClient:
    """Stands for a model: says of each image that it was seen."""

    def invoke(self, parts):
        ids = [p["text"][5:-2] for p in parts if p["type"] == "text" and p["text"].startswith("[ID: ")]
        return "".join(f"<{i}> seen {i} </{i}>" for i in ids), len(parts), len(ids)


def _as_pdf(text: F.Column) -> F.Column:
    """A PDF of two pages whose lines stand in the stream from the last to the first; an image is placed at the end of page 1."""
    lines = F.transform(F.split(text, "\n"), lambda t, i: F.struct(i.alias("i"), F.hex(F.encode(t, "UTF-16BE")).alias("h")))
    block = lambda s: F.concat(F.lit("BT 1 0 0 1 10 "), (F.lit(900_000) - s["i"] * 10).cast("string"), F.lit(" Tm <FEFF"), s["h"], F.lit("> Tj ET\n"))
    shown = F.array_join(F.transform(F.reverse(lines), block), "")
    stream = lambda head, body: F.concat(F.lit(f"<< {head} >>\nstream\n"), body, F.lit("\nendstream"))
    pixels = F.lit("".join(f"{(7 * x * x + 13 * y) % 251:02x}" for y in range(40) for x in range(40)) + ">")
    objects = [
        F.lit("<< /Type /Page /Parent 3 0 R /Contents 5 0 R >>"), F.lit("<< /Type /Catalog /Pages 3 0 R >>"), F.lit("<< /Type /Pages /Kids [4 0 R 1 0 R] /Count 2 >>"),
        F.lit("<< /Type /Page /Parent 3 0 R /Contents 6 0 R /Resources << /XObject << /Im0 7 0 R >> >> >>"), stream("/Length 30", F.lit("BT 10 10 Td (second \\(page\\)) Tj ET")),
        stream("/Length 1", F.concat(F.lit("q 40 0 0 40 10 5 cm /Im0 Do Q\n"), shown)),
        stream("/Type /XObject /Subtype /Image /Width 40 /Height 40 /ColorSpace /DeviceGray /BitsPerComponent 8 /Filter /ASCIIHexDecode", pixels),
    ]
    body = F.concat(*[F.concat(F.lit(f"{i} 0 obj\n"), o, F.lit("\nendobj\n")) for i, o in enumerate(objects, 1)])
    return F.encode(F.concat(F.lit("%PDF-1.4\n"), body), "UTF-8")


@query(rf"""
WITH n AS (SELECT doc_id, 'in/' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.tif' WHEN 2 THEN '.csv' ELSE '.pdf' END AS path FROM documents),
p AS (SELECT doc_id, string_agg({NORMAL_SQL}, '' ORDER BY block_no) FILTER (WHERE line <> '') AS t FROM (SELECT doc_id, block_no, regexp_replace(line, '\s+', ' ', 'g') AS line FROM ({LINES_SQL})) WHERE trim(line) <> '' GROUP BY doc_id),
i AS (SELECT doc_id, path, {ID_SQL} AS image FROM (SELECT doc_id, path, md5(path || '/0/' || (SELECT count(*) FROM ({LINES_SQL}) l WHERE l.doc_id = n.doc_id AND trim(regexp_replace(line, '\s+', ' ', 'g')) <> '')) AS h FROM n))
SELECT path, 0::INT AS part_no, CASE doc_id % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'rejected_image' WHEN 2 THEN 'unsupported' ELSE 'pdf' END AS kind,
 CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE coalesce(t, '') || 'seen ' || image || chr(10) || chr(10) || chr(10) || 'second (page)' || chr(10) END AS text,
 CASE doc_id % 5 WHEN 1 THEN 'rejected_image' WHEN 2 THEN 'unsupported' ELSE 'ok' END AS status
FROM documents JOIN i USING (doc_id) LEFT JOIN p USING (doc_id)""")
def read_documents(spark, sf):
    """The whole path from files to text, by the library's one call: PDF files made of the documents, texts, and files that no reader takes."""
    d = read(spark, sf, "documents")
    k = F.col("doc_id") % 5
    path = F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.when(k == 0, ".txt").when(k == 1, ".tif").when(k == 2, ".csv").otherwise(".pdf"))
    content = F.when(k > 2, _as_pdf(F.col("text"))).otherwise(F.encode("text", "UTF-8"))
    return D.read_files(spark, files.routed(d.select(path.alias("path"), content.alias("content"))), ocr.Options(enable_dedup=False), EchoClient)
