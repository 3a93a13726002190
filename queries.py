"""The registered queries and, for each, the same result as plain SQL.

Every query reads whole tables. Timestamps leave as zone-less timestamps, and
binary values as hex text, so both sides compare alike.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import loadmason as lm
from loadmason.functions.digests import md5_base64, md5_bytes, md5_uuid
from loadmason.operators.batches import whole_batches
from loadmason.operators.rows import fingerprint
from loadmason.plans.sinks import DEFAULT_BATCH_SIZE
from loadmason.session import new_path, tune
from loadmason.streaming.micro_batch import batch_loader

QUERIES = {}
SQL = {}

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


def query(sql: str):
    def keep(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return keep


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, its timestamps in the session's zone (UTC)."""
    df = tune(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.select(
        *[F.col(f.name).cast("timestamp") if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in df.schema]
    )


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, binary as hex."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, T.BinaryType):
            column = F.hex(column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def fresh_table(spark: SparkSession, name: str, target, **options) -> str:
    table = f"{name}_{uuid.uuid4().hex}"
    lm.create_table(spark, table, target, location=new_path(spark, name), **options)
    return table


def low_bits(number: Column, bits: int, kind: str) -> Column:
    """The lowest bits of a long as a signed number of that width; whatever lies above is cut off."""
    rest = 64 - bits
    return F.shiftright(F.shiftleft(number.cast("bigint"), rest), rest).cast(kind)


def cases(*pairs, otherwise) -> Column:
    """``pairs`` of condition and value, tried in order."""
    column = None
    for condition, value in pairs:
        column = F.when(condition, value) if column is None else column.when(condition, value)
    return column.otherwise(otherwise)


# --- scanning delimited text ---------------------------------------------------


@query("SELECT * FROM lineitem")
def scan_tsv_typed(spark, folder):
    """Lines written to files and read back into the same typed columns."""
    lineitem = read(spark, folder, "lineitem")
    path = new_path(spark, "lineitem-tsv")
    lm.write_delimited(lineitem, path)
    return plain(lm.scan_delimited(spark, path, lineitem.schema))


@query(
    """SELECT l_returnflag, count(*) AS n_rows, sum(l_quantity) AS sum_qty,
              cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS sum_price
       FROM lineitem GROUP BY l_returnflag"""
)
def scan_tsv_flagship(spark, folder):
    """Lines parsed into the target schema, then aggregated; unread columns are not parsed."""
    lineitem = read(spark, folder, "lineitem")
    parsed = lm.parse_lines(lm.render(lineitem), lineitem.schema)
    return parsed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("l_quantity").alias("sum_qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
    )


@query("SELECT * FROM orders")
def scan_multichar_sep(spark, folder):
    orders = read(spark, folder, "orders")
    return plain(lm.parse_lines(lm.render(orders, sep="||"), orders.schema, sep="||"))


@query(
    """SELECT event_id,
              CASE WHEN event_id % 4 IN (2, 3) THEN value END AS value,
              CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE event_type END AS tag,
              CASE WHEN event_id % 4 IN (2, 3) THEN date_trunc('millisecond', ts) END AS ts,
              CASE WHEN event_id % 4 IN (2, 3) THEN user_id END AS user_id
       FROM events"""
)
def scan_null_tokens(spark, folder):
    """The null token, empty fields, plain and space-padded fields."""
    kind = F.col("event_id") % 4

    def token(text: Column) -> Column:
        padded = F.concat(F.lit("  "), text, F.lit("  "))
        return cases((kind == 0, F.lit("\\N")), (kind == 1, F.lit("")), (kind == 2, text), otherwise=padded)

    lines = read(spark, folder, "events").select(
        F.concat_ws(
            "\t",
            F.col("event_id").cast("string"),
            token(F.col("value").cast("string")),
            token(F.col("event_type")),
            token(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")),
            token(F.col("user_id").cast("string")),
        )
    )
    return plain(lm.parse_lines(lines, "event_id BIGINT, value FLOAT, tag STRING, ts TIMESTAMP, user_id BIGINT"))


@query(
    """SELECT cause, count(*) AS faults FROM (
         SELECT 'mismatched field counts: expected 3, actual ' || len(string_split(line, ',')) AS cause
         FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
         WHERE len(string_split(line, ',')) <> 3)
       GROUP BY cause"""
)
def scan_bad_arity(spark, folder):
    """Lines of prose as comma-separated rows of three fields: rejects by field count."""
    lines = read(spark, folder, "documents").select(F.explode(F.split("text", "\n", -1)))
    rejects = lm.parse_lines(lines, "a STRING, b STRING, c STRING", sep=",", on_error="reject").rejects
    return lm.fault_by_cause(rejects)


@query("SELECT doc_id, lang, source, rtrim(split_part('.' || text, chr(10), 1)) AS text FROM documents")
def scan_newline_rows(spark, folder):
    """Rows whose last field holds newlines, written as text: their first line is a
    row, the lines after it are rejects."""
    documents = read(spark, folder, "documents").select("doc_id", "lang", "source", F.concat(F.lit("."), "text"))
    path = new_path(spark, "documents-tsv")
    lm.write_delimited(documents, path)
    return lm.scan_delimited(spark, path, "doc_id BIGINT, lang STRING, source STRING, text STRING", on_error="reject").accepted


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber::tinyint END AS tiny,
              CASE WHEN l_linenumber % 3 <> 1 THEN (l_partkey % 30000 - 15000)::smallint END AS small,
              CASE WHEN l_linenumber % 3 <> 2 THEN (l_extendedprice::decimal(18,2))::decimal(38,12) END AS dec
       FROM lineitem"""
)
def scan_small_numbers(spark, folder):
    """Tiny and small whole numbers and decimals, nulls among them, rendered and read back."""
    kind = F.col("l_linenumber") % 3
    numbers = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(kind != 0, F.col("l_linenumber").cast("tinyint")).alias("tiny"),
        F.when(kind != 1, (F.col("l_partkey") % 30000 - 15000).cast("smallint")).alias("small"),
        F.when(kind != 2, F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(38,12)")).alias("dec"),
    )
    path = new_path(spark, "numbers-tsv")
    lm.write_delimited(numbers, path)
    return lm.scan_delimited(spark, path, numbers.schema)


@query("SELECT * FROM lineitem")
def scan_partitioned_folder(spark, folder):
    """Lines in a folder with sub-folders named after a value."""
    lineitem = read(spark, folder, "lineitem")
    path = new_path(spark, "lineitem-by-flag")
    lines = lm.render(lineitem)
    by_flag = lines.withColumn("flag", F.substring_index(F.substring_index("value", "\t", 9), "\t", -1))
    by_flag.write.partitionBy("flag").text(path)
    return plain(lm.scan_delimited(spark, path, lineitem.schema))


@query(
    """SELECT cause, count(*) AS faults FROM (
         SELECT CASE WHEN event_id % 3 = 0 AND event_id % 5 = 0 THEN 'user_id: not a valid INTEGER; value: not a valid FLOAT'
                     WHEN event_id % 3 = 0 THEN 'user_id: not a valid INTEGER'
                     WHEN event_id % 5 = 0 THEN 'value: not a valid FLOAT'
                     WHEN event_id % 7 = 0 THEN 'ts: not a valid TIMESTAMP' END AS cause FROM events)
       WHERE cause IS NOT NULL GROUP BY cause"""
)
def scan_bad_cells(spark, folder):
    """Text, special words and bad dates where numbers and timestamps belong."""
    id_ = F.col("event_id")
    third, fifth = id_ % 3 == 0, id_ % 5 == 0
    seventh = (id_ % 7 == 0) & ~third & ~fifth
    lines = read(spark, folder, "events").select(
        F.concat_ws(
            "\t",
            F.when(third, F.col("event_type")).otherwise(F.col("user_id").cast("string")),
            F.when(fifth, F.lit("inf")).otherwise(F.col("value").cast("string")),
            F.when(seventh, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")),
        )
    )
    rejects = lm.parse_lines(lines, "user_id INTEGER, value FLOAT, ts TIMESTAMP", on_error="reject").rejects
    return lm.fault_by_cause(rejects)


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE hex(event_type) END AS payload FROM events"""
)
def scan_hex_binary(spark, folder):
    """Hex fields, some with a trailing odd digit, some null."""
    kind = F.col("event_id") % 3
    digits = F.hex(F.encode("event_type", "UTF-8"))
    field = cases((kind == 0, digits), (kind == 1, F.concat(digits, F.lit("f"))), otherwise=F.lit("\\N"))
    lines = read(spark, folder, "events").select(F.concat_ws("\t", F.col("event_id").cast("string"), field))
    return plain(lm.parse_lines(lines, "event_id BIGINT, payload VARBINARY"))


@query("SELECT event_id, date_trunc('minute', ts) AS ts FROM events")
def scan_custom_date(spark, folder):
    pattern = "dd/MM/yyyy HH:mm"
    lines = lm.render(read(spark, folder, "events").select("event_id", "ts"), date_format=pattern)
    return plain(lm.parse_lines(lines, "event_id BIGINT, ts TIMESTAMP", date_format=pattern))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load_file_job(spark, folder):
    """Text files loaded into a catalog table."""
    customer = read(spark, folder, "customer")
    path = new_path(spark, "customer-tsv")
    lm.write_delimited(customer, path)
    table = fresh_table(spark, "customer", customer.schema)
    lm.load_file(spark, path, table)
    return spark.table(table)


# --- rendering -----------------------------------------------------------------


@query(
    r"""SELECT concat_ws(chr(9), cast(o_orderkey AS varchar), cast(o_custkey AS varchar), o_orderstatus,
                 rtrim(rtrim(cast(cast(o_totalprice AS decimal(18,2)) AS varchar), '0'), '.'),
                 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g'), o_orderpriority) AS value FROM orders"""
)
def render_tsv(spark, folder):
    orders = read(spark, folder, "orders")
    return lm.render(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")))


@query(
    r"""SELECT concat_ws('|', cast(event_id AS varchar),
                 CASE WHEN event_id % 2 = 0 THEN '' ELSE cast(user_id AS varchar) END,
                 CASE WHEN event_id % 3 = 0 THEN '\N' ELSE event_type END,
                 CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END,
                 CASE WHEN event_id % 7 = 0 THEN '\N' ELSE lower(hex(event_type)) END) AS value FROM events"""
)
def render_nulls(spark, folder):
    """Null numbers and timestamps are empty; null strings and binaries are marked."""
    id_ = F.col("event_id")
    rows = read(spark, folder, "events").select(
        id_,
        F.when(id_ % 2 != 0, F.col("user_id")),
        F.when(id_ % 3 != 0, F.col("event_type")),
        F.when(id_ % 5 != 0, F.col("ts")),
        F.when(id_ % 7 != 0, F.encode("event_type", "UTF-8")),
    )
    return lm.render(rows.toDF("a", "b", "c", "d", "e"), sep="|")


# --- the conversion matrix -------------------------------------------------------


WIDENINGS = [
    (source, into)
    for source, targets in {
        "b": ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING"],
        "s": ["SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING"],
        "i": ["INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING"],
        "l": ["BIGINT", "FLOAT", "DECIMAL", "STRING"],
    }.items()
    for into in targets
]
SQL_TYPE = {"FLOAT": "double", "DECIMAL": "decimal(38,12)", "STRING": "varchar"}


@query(
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"cast({s} AS {SQL_TYPE.get(t, t)}) AS {s}_{t.lower()}" for s, t in WIDENINGS)
    + """ FROM (SELECT *, cast(l_linenumber AS tinyint) AS b, cast(l_partkey % 32768 AS smallint) AS s,
                 cast(l_orderkey - l_partkey AS integer) AS i, l_orderkey * 1000003 - l_partkey AS l FROM lineitem)"""
)
def widen_ints(spark, folder):
    """Every identity and widening of the four whole-number sources."""
    sources = read(spark, folder, "lineitem").select(
        *LINEITEM_KEY,
        F.col("l_linenumber").cast("tinyint").alias("b"),
        (F.col("l_partkey") % 32768).cast("smallint").alias("s"),
        (F.col("l_orderkey") - F.col("l_partkey")).cast("int").alias("i"),
        (F.col("l_orderkey") * 1000003 - F.col("l_partkey")).alias("l"),
    )
    converted = lm.convert_columns(
        sources, [(f"{s}_{t.lower()}", F.col(s), t) for s, t in WIDENINGS], keep=LINEITEM_KEY
    )
    return converted.select(*LINEITEM_KEY, *[f"{s}_{t.lower()}" for s, t in WIDENINGS])


def edges(low: int, high: int, row: str, otherwise: str) -> str:
    """SQL that puts values at and around both bounds into some rows, and a null."""
    return (
        f"CASE {row} % 50 WHEN 0 THEN {low} WHEN 1 THEN {low + 1} WHEN 2 THEN {low - 1} "
        f"WHEN 3 THEN {high} WHEN 4 THEN {high + 1} WHEN 5 THEN {high - 1} WHEN 6 THEN NULL ELSE {otherwise} END"
    )


NARROWINGS = {
    "narrow_long_tiny": ("bigint", "TINYINT", -(2**7), 2**7 - 1, "l_partkey - l_suppkey"),
    "narrow_long_small": ("bigint", "SMALLINT", -(2**15), 2**15 - 1, "l_partkey * 37 - l_orderkey"),
    "narrow_long_int": ("bigint", "INTEGER", -(2**31), 2**31 - 1, "l_orderkey * 400009 - l_partkey"),
    "narrow_int_tiny": ("int", "TINYINT", -(2**7), 2**7 - 1, "l_partkey - l_suppkey"),
    "narrow_int_small": ("int", "SMALLINT", -(2**15), 2**15 - 1, "l_partkey * 37 - l_orderkey"),
    "narrow_short_tiny": ("smallint", "TINYINT", -(2**7), 2**7 - 1, "l_suppkey % 300 - l_linenumber * 30"),
}


def narrowing(name: str, source: str, into: str, low: int, high: int, otherwise: str) -> None:
    value = edges(low, high, "l_orderkey", otherwise)

    @query(
        f"""SELECT l_orderkey, l_linenumber,
                   CASE WHEN x > {low} AND x <= {high} THEN cast(x AS {into}) END AS v,
                   x IS NOT NULL AND NOT (x > {low} AND x <= {high}) AS v_refused
            FROM (SELECT l_orderkey, l_linenumber, cast({value} AS bigint) AS x FROM lineitem)"""
    )
    def run(spark, folder):
        lineitem = read(spark, folder, "lineitem")
        return lm.convert_columns(lineitem, [("v", F.expr(f"cast({value} as {source})"), into)], keep=LINEITEM_KEY)

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _name, _spec in NARROWINGS.items():
    narrowing(_name, *_spec)

WHOLE = {
    "tinyint": (-(2**7), 2**7 - 1),
    "smallint": (-(2**15), 2**15 - 1),
    "integer": (-(2**31), 2**31 - 1),
    "bigint": (-(2**63), 2**63 - 1),
}
DOUBLE_CASE = """CASE c_custkey % 40 WHEN 0 THEN 127.5 WHEN 1 THEN -128.0 WHEN 2 THEN -127.9 WHEN 3 THEN 127.0
                   WHEN 4 THEN 32767.0 WHEN 5 THEN 32767.5 WHEN 6 THEN -32768.0 WHEN 7 THEN 2147483647.0
                   WHEN 8 THEN 2147483647.5 WHEN 9 THEN -2147483648.0 WHEN 10 THEN NULL WHEN 11 THEN 1e300
                   WHEN 12 THEN -9223372036854775808.0 ELSE c_acctbal * (1 + c_custkey % 3 * 99) END"""


@query(
    "SELECT c_custkey, "
    + ", ".join(
        f"CASE WHEN x > {low} AND x <= {high} THEN cast(trunc(x) AS {t}) END AS v_{t}, "
        f"x IS NOT NULL AND NOT (x > {low} AND x <= {high}) AS v_{t}_refused"
        for t, (low, high) in {k: (f"cast({a} AS double)", f"cast({b} AS double)") for k, (a, b) in WHOLE.items()}.items()
    )
    + f" FROM (SELECT c_custkey, cast({DOUBLE_CASE} AS double) AS x FROM customer)"
)
def double_to_ints(spark, folder):
    """The range is tested on the double, the fraction is then cut off."""
    source = F.expr(f"cast({DOUBLE_CASE.replace('.0 ', '.0D ').replace('.5 ', '.5D ').replace('.9 ', '.9D ')} as double)")
    return lm.convert_columns(
        read(spark, folder, "customer"), [(f"v_{t}", source, t.upper()) for t in WHOLE], keep=["c_custkey"]
    )


@query(
    """SELECT l_orderkey, l_linenumber, cast(cast(l_extendedprice AS decimal(18,2)) AS decimal(38,12)) AS price,
              cast(l_extendedprice AS varchar) AS price_text, l_discount AS discount FROM lineitem"""
)
def double_to_decimal_text(spark, folder):
    converted = lm.convert_columns(
        read(spark, folder, "lineitem"),
        [
            ("price", F.col("l_extendedprice"), "DECIMAL"),
            ("price_text", F.col("l_extendedprice"), "STRING"),
            ("discount", F.col("l_discount"), "FLOAT"),
        ],
        keep=LINEITEM_KEY,
        strictly=True,
    )
    return converted.select(*LINEITEM_KEY, "price", "price_text", "discount")


@query(
    """SELECT event_id, make_timestamp_ms(cast(trunc(x * 1000) AS bigint)) AS v, false AS v_refused
       FROM (SELECT event_id, (epoch_us(ts) // 1000) / 1000.0::double AS x FROM events)"""
)
def double_to_ts(spark, folder):
    """Doubles are seconds."""
    source = F.unix_millis("ts") / F.lit(1000.0)
    return plain(lm.convert_columns(read(spark, folder, "events"), [("v", source, "TIMESTAMP")], keep=["event_id"]))


@query(
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN make_timestamp_ms(epoch_us(ts) // 1000) END AS v,
              event_id % 9 = 0 AS v_refused FROM events"""
)
def long_to_ts(spark, folder):
    """Whole numbers are milliseconds; one that no timestamp can hold is refused."""
    source = F.when(F.col("event_id") % 9 == 0, F.lit(2**63 - 1)).otherwise(F.unix_millis("ts"))
    return plain(lm.convert_columns(read(spark, folder, "events"), [("v", source, "TIMESTAMP")], keep=["event_id"]))


@query(
    """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN make_timestamp_ms(epoch_us(ts) // 1000) END AS v,
              event_id % 4 = 0 AS v_refused FROM events"""
)
def decimal_to_ts(spark, folder):
    """Decimals are milliseconds; a fraction is refused."""
    half = F.when(F.col("event_id") % 4 == 0, F.lit(0.5)).otherwise(F.lit(0.0)).cast("decimal(2,1)")
    source = F.unix_millis("ts").cast("decimal(20,1)") + half
    return plain(lm.convert_columns(read(spark, folder, "events"), [("v", source, "TIMESTAMP")], keep=["event_id"]))


@query(
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"CASE WHEN x = floor(x) AND x BETWEEN {low} AND {high} THEN cast(x AS {t}) END AS v_{t}, "
        f"x IS NOT NULL AND NOT (x = floor(x) AND x BETWEEN {low} AND {high}) AS v_{t}_refused"
        for t, (low, high) in WHOLE.items()
    )
    + """, cast(x AS double) AS v_float,
         CASE WHEN x = floor(x) THEN cast(cast(x AS decimal(38,0)) AS varchar)
              ELSE rtrim(cast(x AS varchar), '0') END AS v_string,
         hex(cast(cast(cast(cast(x AS decimal(38,2)) * 100 AS hugeint) * 10000000000 AS bit) AS blob)) AS v_varbinary """
    + """FROM (SELECT l_orderkey, l_linenumber, CASE
             WHEN l_orderkey % 50 IN (0,1,2,3,4,5,6,7,8,9,10,11,12,13) THEN cast(CASE l_orderkey % 50 WHEN 0 THEN -128 WHEN 1 THEN -129
               WHEN 2 THEN 127 WHEN 3 THEN 128 WHEN 4 THEN -32768 WHEN 5 THEN -32769 WHEN 6 THEN 32767 WHEN 7 THEN 32768
               WHEN 9 THEN -2147483648 WHEN 10 THEN 2147483648 WHEN 11 THEN -9223372036854775808
               WHEN 12 THEN 9223372036854775807 WHEN 13 THEN 9223372036854775808 END AS decimal(38,2))
             WHEN l_orderkey % 50 = 14 THEN cast(l_quantity AS decimal(38,2))
             ELSE cast(l_extendedprice AS decimal(38,2)) END AS x FROM lineitem)"""
)
def decimal_exact_ints(spark, folder):
    """Whole numbers in range only, both bounds included; also double, text and 16 bytes."""
    key = F.col("l_orderkey") % 50
    fixed = {0: -128, 1: -129, 2: 127, 3: 128, 4: -32768, 5: -32769, 6: 32767, 7: 32768, 9: -(2**31), 10: 2**31,
             11: -(2**63), 12: 2**63 - 1, 13: 2**63}
    source = cases(
        *[(key == k, F.lit(str(v)).cast("decimal(38,2)")) for k, v in fixed.items()],
        (key == 8, F.lit(None).cast("decimal(38,2)")),
        (key == 14, F.col("l_quantity").cast("decimal(38,2)")),
        otherwise=F.col("l_extendedprice").cast("decimal(38,2)"),
    )
    wanted = [*WHOLE, "float", "string", "varbinary"]
    rows = read(spark, folder, "lineitem").select(*LINEITEM_KEY, source.alias("x"))
    converted = lm.convert_columns(rows, [(f"v_{t}", F.col("x"), t.upper()) for t in wanted], keep=LINEITEM_KEY)
    return plain(converted.drop("v_float_refused", "v_string_refused", "v_varbinary_refused"))


STRING_CASE = """CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN ' \\\\N ' WHEN 3 THEN NULL
                   WHEN 4 THEN ' 5 ' WHEN 5 THEN '1e2' WHEN 6 THEN '+7' ELSE {digits} END"""


@query(
    "SELECT p_partkey, "
    + ", ".join(
        f"CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN try_cast(x AS {t}) END AS v_{t}, "
        f"x IS NOT NULL AND trim(x) NOT IN ('', '\\N') AND "
        f"(NOT regexp_full_match(x, '[+-]?[0-9]+') OR try_cast(x AS {t}) IS NULL) AS v_{t}_refused"
        for t in WHOLE
    )
    + r""", CASE WHEN trim(x) NOT IN ('', '\N') THEN cast(x AS double) END AS v_float, false AS v_float_refused,
         CASE WHEN trim(x) NOT IN ('', '\N') THEN cast(cast(x AS double) AS decimal(38,12)) END AS v_decimal, false AS v_decimal_refused,
         x AS v_string, false AS v_string_refused, hex(x) AS v_varbinary, false AS v_varbinary_refused"""
    + " FROM (SELECT p_partkey, " + STRING_CASE.replace("\\\\", "\\").format(digits="cast(p_partkey * p_size AS varchar)") + " AS x FROM part)"
)
def string_to_all(spark, folder):
    """Blank and null-token text is null; whole numbers are not trimmed, doubles and decimals are."""
    source = F.expr(STRING_CASE.format(digits="cast(p_partkey * p_size as string)"))
    wanted = [*WHOLE, "float", "decimal", "string", "varbinary"]
    return plain(
        lm.convert_columns(read(spark, folder, "part"), [(f"v_{t}", source, t.upper()) for t in wanted], keep=["p_partkey"])
    )


@query(
    """SELECT event_id, date_trunc('millisecond', ts) AS v, false AS v_refused, NULL::timestamp AS w, true AS w_refused
       FROM events"""
)
def string_to_ts(spark, folder):
    good = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    bad = F.date_format("ts", "yyyy-13-dd HH:mm:ss.SSS")
    return plain(
        lm.convert_columns(
            read(spark, folder, "events"), [("v", good, "TIMESTAMP"), ("w", bad, "TIMESTAMP")], keep=["event_id"]
        )
    )


@query(
    """SELECT l_orderkey, l_linenumber, right(hex(cast(cast(b AS bigint)::bit AS blob)), 2) AS b,
              right(hex(cast(cast(s AS bigint)::bit AS blob)), 4) AS s, right(hex(cast(cast(i AS bigint)::bit AS blob)), 8) AS i,
              hex(cast(cast(l AS bigint)::bit AS blob)) AS l, hex(cast(l_extendedprice::bit AS blob)) AS d,
              hex(l_returnflag) AS t, l_returnflag AS back
       FROM (SELECT *, l_linenumber - 4 AS b, l_suppkey - l_linenumber * 40 AS s, l_orderkey - l_partkey AS i,
                    l_orderkey * 1000003 - l_partkey * 7000000 AS l FROM lineitem)"""
)
def bytes_cells(spark, folder):
    """Whole numbers, doubles and text as bytes, and bytes as text."""
    sources = read(spark, folder, "lineitem").select(
        *LINEITEM_KEY,
        # as many keys as a large table has do not fit the narrow types; the result shows these bits only
        low_bits(F.col("l_linenumber") - 4, 8, "tinyint").alias("b"),
        low_bits(F.col("l_suppkey") - F.col("l_linenumber") * 40, 16, "smallint").alias("s"),
        low_bits(F.col("l_orderkey") - F.col("l_partkey"), 32, "int").alias("i"),
        (F.col("l_orderkey") * 1000003 - F.col("l_partkey") * 7000000).alias("l"),
        F.col("l_extendedprice").alias("d"),
        F.col("l_returnflag").alias("t"),
    )
    wanted = [(c, F.col(c), "VARBINARY") for c in "bsildt"] + [("back", F.encode("t", "UTF-8"), "STRING")]
    converted = lm.convert_columns(sources, wanted, keep=LINEITEM_KEY)
    return plain(converted.select(*LINEITEM_KEY, *[name for name, _, _ in wanted]))


@query(
    """SELECT event_id, ms AS v_bigint, ms / 1000.0::double AS v_float, cast(ms AS decimal(38,12)) AS v_decimal,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS v_string, hex(cast(ms::bit AS blob)) AS v_varbinary,
              date_trunc('millisecond', ts) AS v_timestamp
       FROM (SELECT event_id, ts, cast(epoch_us(ts) // 1000 AS bigint) AS ms FROM events)"""
)
def date_to_all(spark, folder):
    wanted = ["BIGINT", "FLOAT", "DECIMAL", "STRING", "VARBINARY", "TIMESTAMP"]
    converted = lm.convert_columns(
        read(spark, folder, "events"), [(f"v_{t.lower()}", F.col("ts"), t) for t in wanted], keep=["event_id"], strictly=True
    )
    return plain(converted.select("event_id", *[f"v_{t.lower()}" for t in wanted]))


@query(
    """SELECT event_id,
              CASE WHEN rejected IS NULL THEN user_id END AS user_id,
              rejected AS cause
       FROM (SELECT event_id, user_id, CASE WHEN user_id * 7 - 200 > 127 OR user_id * 7 - 200 <= -128
               THEN 'small: bigint does not fit TINYINT' END AS rejected FROM events)"""
)
def coerce_rejects(spark, folder):
    """Accepted rows and rejects of one loose coercion, side by side."""
    events = read(spark, folder, "events").select("event_id", "user_id", (F.col("user_id") * 7 - 200).alias("x"))
    accepted, rejects = lm.coerce(events, "event_id BIGINT, user_id BIGINT, small TINYINT", mode="loose", on_error="reject")
    rejected = rejects.select(
        F.split_part("row_text", F.lit("|"), F.lit(1)).cast("bigint").alias("event_id"),
        F.lit(None).cast("bigint").alias("user_id"),
        "cause",
    )
    return accepted.select("event_id", "user_id", F.lit(None).cast("string").alias("cause")).unionByName(rejected)


# --- digests and whole rows -------------------------------------------------------


@query(
    r"""SELECT doc_id, md5(source) AS md5_hex, to_base64(unhex(md5(text))) AS md5_b64,
              regexp_replace(md5(source), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS md5_id FROM documents"""
)
def md5_forms(spark, folder):
    return read(spark, folder, "documents").select(
        "doc_id",
        F.lower(F.hex(md5_bytes(F.col("source")))).alias("md5_hex"),
        md5_base64(F.col("text")).alias("md5_b64"),
        md5_uuid(F.col("source")).alias("md5_id"),
    )


ALTERED = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CASE WHEN l_orderkey % 10 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
             FROM lineitem WHERE l_orderkey % 10 <> 1"""


@query(
    f"""SELECT *, 'left' AS only_in, count(*) AS copies FROM (SELECT * FROM lineitem EXCEPT ALL ({ALTERED})) GROUP BY ALL
        UNION ALL
        SELECT *, 'right' AS only_in, count(*) AS copies FROM (({ALTERED}) EXCEPT ALL SELECT * FROM lineitem) GROUP BY ALL"""
)
def row_diff(spark, folder):
    lineitem = read(spark, folder, "lineitem")
    altered = lineitem.filter(F.col("l_orderkey") % 10 != 1).withColumn(
        "l_quantity", F.when(F.col("l_orderkey") % 10 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return plain(lm.row_diff(lineitem, altered))


@query(
    """SELECT o_orderkey, change, columns, left_rows, right_rows FROM (
         SELECT o_orderkey, 'changed' AS change, 'o_orderstatus' || CASE WHEN o_orderkey % 4 = 0 THEN ',o_totalprice' ELSE '' END AS columns,
                1::bigint AS left_rows, 1::bigint AS right_rows FROM orders WHERE o_orderkey % 10 = 0
         UNION ALL SELECT o_orderkey, 'removed', NULL, 1, 0 FROM orders WHERE o_orderkey % 10 = 1
         UNION ALL SELECT o_orderkey + 1000000000000, 'added', NULL, 0, 1 FROM orders WHERE o_orderkey % 10 = 2)"""
)
def key_diff(spark, folder):
    """Keys added, removed and changed, with the changed columns."""
    orders = read(spark, folder, "orders")
    key = F.col("o_orderkey")
    altered = (
        orders.filter(key % 10 != 1)
        .withColumn("o_orderstatus", F.when(key % 10 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
        .withColumn("o_totalprice", F.when(key % 20 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    )
    added = orders.filter(key % 10 == 2).withColumn("o_orderkey", key + 1000000000000)
    return lm.key_diff(orders, altered.unionByName(added), ["o_orderkey"])


@query(
    """SELECT o_orderkey, 'changed' AS change, 'o_totalprice' AS columns, 1::bigint AS left_rows, 1::bigint AS right_rows
       FROM orders WHERE o_orderkey % 1000 = 7
       UNION ALL SELECT o_orderkey, 'removed', NULL, 1, 0 FROM orders WHERE o_orderkey % 1000 = 8"""
)
def key_diff_digests(spark, folder):
    """Few differences in a large table, found by digests of buckets before any row is shuffled."""
    orders = read(spark, folder, "orders")
    key = F.col("o_orderkey")
    altered = orders.filter(key % 1000 != 8).withColumn(
        "o_totalprice", F.when(key % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return lm.key_diff(orders, altered, ["o_orderkey"], digest_levels=2)


@query(
    """SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
              l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS n_fingerprints
       FROM lineitem GROUP BY l_returnflag"""
)
def row_fingerprint(spark, folder):
    """As many fingerprints as distinct rows."""
    lineitem = read(spark, folder, "lineitem")
    marked = lineitem.select("l_returnflag", fingerprint([F.col(c) for c in lineitem.columns], "lineitem").alias("f"))
    return marked.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("f").alias("n_fingerprints")
    )


# --- loading -----------------------------------------------------------------------


@query(
    """SELECT event_id, cast(user_id AS integer) AS i, user_id AS l, value AS f, value AS d,
              cast(CASE WHEN value > 50 THEN 1 ELSE 0 END AS tinyint) AS b,
              cast(cast(value AS decimal(18,2)) AS decimal(38,12)) AS c, cast(user_id AS decimal(38,12)) AS n,
              event_type AS s, hex(event_type) AS y, date_trunc('millisecond', ts) AS t
       FROM events"""
)
def pig_row(spark, folder):
    """All ten kinds of source field stored strictly into a table."""
    source = read(spark, folder, "events").select(
        "event_id",
        F.col("user_id").cast("int"),
        "user_id",
        F.col("value"),
        F.col("value"),
        F.col("value") > 50,
        F.col("value").cast("decimal(18,2)"),
        F.col("user_id").cast("decimal(38,0)"),
        "event_type",
        F.encode("event_type", "UTF-8"),
        "ts",
    )
    target = (
        "event_id BIGINT, i INTEGER, l BIGINT, f FLOAT, d FLOAT, b TINYINT, c DECIMAL, n DECIMAL, s STRING, y VARBINARY, t TIMESTAMP"
    )
    table = fresh_table(spark, "store", target)
    lm.store(source.toDF(*[f"f{i}" for i in range(11)]), table, on_error="reject")
    return plain(spark.table(table))


@query("SELECT event_id, cast(value AS float)::double AS wide FROM events")
def float_widening(spark, folder):
    """4-byte floats widen to 8 bytes before conversion."""
    events = read(spark, folder, "events").select("event_id", F.col("value").cast("float"))
    return lm.coerce(events, "event_id BIGINT, wide FLOAT")


@query(
    """SELECT l_linenumber::tinyint AS a, (l_suppkey % 30000)::smallint AS b, l_partkey::integer AS c, l_orderkey AS d,
              l_quantity::double AS e, (l_extendedprice::decimal(18,2))::decimal(38,12) AS f, l_returnflag AS g,
              hex(l_linestatus) AS h, l_shipdate::timestamp AS i FROM lineitem"""
)
def exact_insert(spark, folder):
    """All nine types of target column from fields of just these types."""
    source = read(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("tinyint").alias("a"),
        (F.col("l_suppkey") % 30000).cast("smallint").alias("b"),
        F.col("l_partkey").cast("int").alias("c"),
        F.col("l_orderkey").cast("bigint").alias("d"),
        F.col("l_quantity").cast("double").alias("e"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(26,12)").alias("f"),
        F.col("l_returnflag").alias("g"),
        F.encode("l_linestatus", "UTF-8").alias("h"),
        F.col("l_shipdate").cast("timestamp").alias("i"),
    )
    target = "a TINYINT, b SMALLINT, c INTEGER, d BIGINT, e FLOAT, f DECIMAL, g STRING, h VARBINARY, i TIMESTAMP"
    table = fresh_table(spark, "exact", target)
    lm.insert_exact(source, table)
    return plain(spark.table(table))


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props FROM events")
def store_format(spark, folder):
    """Any frame stored into a table whose columns it fits strictly."""
    events = read(spark, folder, "events")
    table = fresh_table(spark, "stored", events.schema)
    lm.store(events, table)
    return plain(spark.table(table))


@query(
    """SELECT rows_in_file, count(*) AS n_files FROM (
         SELECT count(*) AS rows_in_file FROM (SELECT (row_number() OVER () - 1) // 300 AS file FROM orders) GROUP BY file)
       GROUP BY rows_in_file"""
)
def batch_size(spark, folder):
    """Rows stored in batches of the default size, from as many tasks as there are: every file but the last holds one."""
    orders = read(spark, folder, "orders")
    table = fresh_table(spark, "batches", orders.schema)
    lm.store(whole_batches(orders, DEFAULT_BATCH_SIZE), table, batch_size=0)
    files = spark.table(table).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows_in_file"))
    return files.groupBy("rows_in_file").agg(F.count(F.lit(1)).alias("n_files"))


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT * FROM orders WHERE o_orderkey % 2 = 1")
def load_append(spark, folder):
    """Two batches appended, the second in small files."""
    orders = read(spark, folder, "orders")
    table = fresh_table(spark, "append", orders.schema)
    lm.load(orders.filter("o_orderkey % 2 = 0"), table)
    lm.load(orders.filter("o_orderkey % 2 = 1"), table, max_records_per_file=1_000_000)
    return plain(spark.table(table))


LINEITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
LINEITEM_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
WHATEVER = 2**62  # a limit that no fault count reaches


@query(
    f"""SELECT {LINEITEM_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, {LINEITEM_REST}) AS n FROM lineitem) WHERE n = 1"""
)
def append_key_rejects(spark, folder):
    """The first row of every key is loaded, the others are rejected."""
    lineitem = read(spark, folder, "lineitem")
    table = fresh_table(spark, "keyed", lineitem.schema)
    lm.load(lineitem, table, keys=LINEITEM_KEY, order_by=["l_shipdate"], max_errors=WHATEVER)
    return plain(spark.table(table))


@query(
    """SELECT cause, count(*) AS faults FROM (
         SELECT CASE WHEN l_orderkey % 2 = 0 AND EXISTS (SELECT 1 FROM lineitem p WHERE p.l_orderkey = r.l_orderkey
                       AND p.l_linenumber = r.l_linenumber AND p.l_orderkey % 2 = 0) THEN 'key already in target'
                     WHEN n > 1 THEN 'repeated key' END AS cause
         FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate) AS n FROM lineitem) r)
       WHERE cause IS NOT NULL GROUP BY cause"""
)
def append_reject_causes(spark, folder):
    """Rejects of a second load, over a table that holds half of its keys."""
    lineitem = read(spark, folder, "lineitem")
    table = fresh_table(spark, "keyed", lineitem.schema)
    rejects = new_path(spark, "rejects")
    lm.load(lineitem.filter("l_orderkey % 2 = 0"), table, keys=LINEITEM_KEY, max_errors=WHATEVER)
    lm.load(lineitem, table, keys=LINEITEM_KEY, max_errors=WHATEVER, reject_path=rejects)
    return lm.fault_by_cause(spark.read.parquet(rejects))


UPSERT_SQL = f"""
  SELECT {LINEITEM_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY part DESC, l_shipdate DESC,
      {', '.join(c + ' DESC' for c in LINEITEM_REST.split(', ') if c != 'l_shipdate')}) AS n
    FROM (SELECT *, 1 AS part FROM lineitem WHERE l_suppkey % 2 = 0
          UNION ALL SELECT *, 2 AS part FROM lineitem WHERE l_suppkey % 2 = 1)) WHERE n = 1"""


@query(UPSERT_SQL)
def load_upsert(spark, folder):
    """One half of the rows loaded over the other; the last row of a key stays."""
    lineitem = read(spark, folder, "lineitem")
    table = fresh_table(spark, "upsert", lineitem.schema)
    for half in (0, 1):
        rows = lineitem.filter(F.col("l_suppkey") % 2 == half)
        lm.load(rows, table, mode="upsert", keys=LINEITEM_KEY, order_by=["l_shipdate"])
    return plain(spark.table(table))


@query(UPSERT_SQL)
def upsert_bucketed(spark, folder):
    """The same into a table bucketed on the key, whose rows need no shuffle."""
    lineitem = read(spark, folder, "lineitem")
    table = fresh_table(spark, "upsert", lineitem.schema, bucket_by=LINEITEM_KEY, buckets=8)
    for half in (0, 1):
        rows = lineitem.filter(F.col("l_suppkey") % 2 == half)
        lm.load(rows, table, mode="upsert", keys=LINEITEM_KEY, order_by=["l_shipdate"])
    return plain(spark.table(table))


@query(UPSERT_SQL)
def upsert_partitioned(spark, folder):
    """The same into a table partitioned by a key column: only touched partitions are written anew."""
    lineitem = read(spark, folder, "lineitem")
    last = [c for c in lineitem.columns if c != "l_linenumber"] + ["l_linenumber"]
    shifted = lineitem.select(*last)
    table = fresh_table(spark, "upsert", shifted.schema, partition_by=["l_linenumber"])
    for half in (0, 1):
        rows = shifted.filter(F.col("l_suppkey") % 2 == half)
        lm.load(rows, table, mode="upsert", keys=LINEITEM_KEY, order_by=["l_shipdate"])
    return plain(spark.table(table).select(*lineitem.columns))


@query(
    """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 OR o_orderstatus = 'F' THEN 'M' ELSE o_orderstatus END AS o_orderstatus)
       FROM orders"""
)
def upsert_moved_partition(spark, folder):
    """Rows that move to another partition, which their key does not name; one partition loses all its rows."""
    orders = read(spark, folder, "orders")
    last = orders.select(*[c for c in orders.columns if c != "o_orderstatus"], "o_orderstatus")
    table = fresh_table(spark, "moved", last.schema, partition_by=["o_orderstatus"])
    lm.load(last, table, mode="upsert", keys=["o_orderkey"])
    moved = last.filter("o_orderkey % 3 = 0 OR o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("M"))
    lm.load(moved, table, mode="upsert", keys=["o_orderkey"])
    return plain(spark.table(table).select(*orders.columns))


@query(
    """SELECT user_id, event_type, event_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1"""
)
def upsert_file_order(spark, folder):
    """Files whose keys repeat: the last line of a key stays, though it need not be the greatest."""
    events = read(spark, folder, "events")
    path = new_path(spark, "events-in-order")
    lines = lm.render(events.orderBy("event_id").select("user_id", "event_type", "event_id"))
    # parts are named in the order of their lines
    lines.write.text(path)
    table = fresh_table(spark, "ordered", "user_id BIGINT, event_type STRING, event_id BIGINT")
    lm.load_file(spark, path, table, mode="upsert", keys=["user_id"])
    return spark.table(table)


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus FROM orders
       UNION ALL SELECT -o_orderkey - 1, o_custkey, 'N' FROM orders WHERE o_orderkey % 1000 = 0"""
)
def upsert_by_file(spark, folder):
    """A few keys of a table of many files, some of them new: only the files that hold one are written anew."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table = fresh_table(spark, "by_file", orders.schema)
    lm.load(orders.repartitionByRange(40, "o_orderkey"), table)
    few = orders.where("o_orderkey % 1000 = 0").withColumn("o_orderstatus", F.lit("N"))
    lm.load(few.unionByName(few.withColumn("o_orderkey", -F.col("o_orderkey") - 1)), table, mode="upsert", keys=["o_orderkey"])
    return plain(spark.table(table))


@query("SELECT o_orderkey, o_custkey, true AS stopped FROM orders")
def early_stop(spark, folder):
    """A load that finds nothing but faults stops before it has read everything; the table keeps the rows it had."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    table = fresh_table(spark, "stopped", orders.schema)
    lm.load(orders, table)
    path = new_path(spark, "bad-lines")
    bad = orders.select(F.concat(F.lit("x"), "o_orderkey"), "o_custkey")
    lm.render(bad).repartition(100).write.text(path)
    try:
        lm.load_file(spark, path, table, on_error="reject", max_errors=100)
        stopped = False
    except lm.LoadAborted as aborted:
        kept = spark.read.parquet(aborted.report.reject_path).count()
        stopped = not aborted.report.whole and 100 <= kept < orders.count()
    return plain(spark.table(table)).withColumn("stopped", F.lit(stopped))


@query("SELECT event_id, user_id, event_type FROM events")
def load_once(spark, folder):
    """Files loaded in two runs, the second of which finds the first one's files again."""
    events = read(spark, folder, "events").select("event_id", "user_id", "event_type")
    table = fresh_table(spark, "once", events.schema)
    path = new_path(spark, "arriving")
    for rest in (0, 1, None):
        if rest is not None:
            lm.render(events.where(F.pmod("event_id", F.lit(2)) == rest)).write.mode("append").text(path)
        lm.load_file(spark, path, table, once=True)
    return plain(spark.table(table))


@query("SELECT event_id, user_id FROM events")
def batch_replayed(spark, folder):
    """Batches of a stream that come again after their commit add nothing."""
    events = read(spark, folder, "events").select("event_id", "user_id")
    table = fresh_table(spark, "replayed", events.schema)
    run = batch_loader(spark, table, new_path(spark, "replayed-checkpoint"))
    for number in (0, 0, 1, 0, 1):
        run(events.where(F.pmod("event_id", F.lit(2)) == number), number)
    return plain(spark.table(table))


@query(
    """SELECT 'repeated key' AS cause, user_id || '|' || event_type || '|' || event_id AS row_text FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n > 1
       UNION ALL
       SELECT 'key already in target', user_id || '|' || event_type || '|' || event_id FROM events
       UNION ALL
       SELECT 'user_id: not a valid INTEGER', event_id || chr(9) || event_type FROM events WHERE event_id % 10 = 0"""
)
def reject_rows(spark, folder):
    """Every rejected row with its text: repeated keys, keys the target holds, and lines that cannot be read."""
    events = read(spark, folder, "events")
    keyed = events.select("user_id", "event_type", "event_id")
    table = fresh_table(spark, "rejecting", keyed.schema)
    rejects = [new_path(spark, "rejects") for _ in range(3)]
    for path in rejects[:2]:
        lm.load(keyed, table, keys=["user_id", "event_type"], order_by=["event_id"], max_errors=WHATEVER, reject_path=path)
    lines = events.select(
        F.concat_ws(
            "\t",
            F.col("event_id").cast("string"),
            F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string")),
        )
    )
    source = new_path(spark, "bad-events")
    lines.write.text(source)
    typed = fresh_table(spark, "events", "event_id BIGINT, user_id INTEGER")
    lm.load_file(spark, source, typed, on_error="reject", max_errors=WHATEVER, reject_path=rejects[2])
    return reduce(DataFrame.unionByName, [spark.read.parquet(path).select("cause", "row_text") for path in rejects])


def events_with_bad_values(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a word where a number belongs (1 in 10), a field too many (1 in 10) and good ones."""
    kind = F.col("event_id") % 10
    return read(spark, folder, "events").select(
        F.concat_ws(
            "\t",
            F.col("event_id").cast("string"),
            F.when(kind == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string")),
            F.when(kind == 1, F.lit("1\t2")).otherwise(F.col("value").cast("string")),
        )
    )


BAD_EVENTS = "event_id BIGINT, user_id INTEGER, value FLOAT"


@query(
    """SELECT faults, max_errors, faults >= max_errors AS reached
       FROM (SELECT count(*) FILTER (event_id % 10 IN (0, 1)) AS faults FROM events),
            (SELECT unnest([1, 10, 4611686018427387904]) AS max_errors)"""
)
def fault_limit(spark, folder):
    """Limits below and above the number of faults."""
    rejects = lm.parse_lines(events_with_bad_values(spark, folder), BAD_EVENTS, on_error="reject").rejects
    limits = [lm.fault_limit(rejects, limit) for limit in (1, 10, WHATEVER)]
    return limits[0].unionByName(limits[1]).unionByName(limits[2])


@query(
    """SELECT 'aborted' AS outcome, 0::bigint AS n_loaded, count(*) FILTER (event_id % 10 IN (0, 1)) AS n_rejected FROM events
       UNION ALL
       SELECT 'loaded', count(*) FILTER (event_id % 10 NOT IN (0, 1)), count(*) FILTER (event_id % 10 IN (0, 1)) FROM events"""
)
def load_with_rejects(spark, folder):
    """A load over its limit leaves the table empty; the same load under it fills the table."""
    path = new_path(spark, "bad-events")
    events_with_bad_values(spark, folder).write.text(path)
    kept = []
    for limit in (1, WHATEVER):
        table, rejects = fresh_table(spark, "events", BAD_EVENTS), new_path(spark, "rejects")
        outcome = "loaded"
        try:
            lm.load_file(spark, path, table, on_error="reject", max_errors=limit, reject_path=rejects, stop_early=False)
        except lm.LoadAborted:
            outcome = "aborted"
        for rows, loaded in ((spark.table(table), 1), (spark.read.parquet(rejects), 0)):
            kept.append(rows.select(F.lit(outcome).alias("outcome"), F.lit(loaded).alias("loaded")))
    return reduce(DataFrame.unionByName, kept).groupBy("outcome").agg(
        F.sum("loaded").alias("n_loaded"), F.sum(1 - F.col("loaded")).alias("n_rejected")
    )


@query(
    """SELECT least(25, n) AS n_rows, least(25, n) AS n_known FROM (
         SELECT count(*) FILTER (event_id % 10 IN (0, 1)) AS n FROM events)"""
)
def fault_sample(spark, folder):
    """As many rejects as the limit allows, all of them among the rejects."""
    rejects = lm.parse_lines(events_with_bad_values(spark, folder), BAD_EVENTS, on_error="reject").rejects
    known = rejects.distinct().withColumn("known", F.lit(1))
    sample = lm.fault_sample(rejects, 25)
    return sample.join(known, ["cause", "row_text"], "left").agg(F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_known"))


@query(
    """SELECT cause, count(*) AS faults FROM (
         SELECT CASE event_id % 10 WHEN 0 THEN 'user_id: not a valid INTEGER'
                                   WHEN 1 THEN 'mismatched field counts: expected 3, actual 4' END AS cause FROM events)
       WHERE cause IS NOT NULL GROUP BY cause"""
)
def fault_by_cause(spark, folder):
    return lm.fault_by_cause(
        lm.parse_lines(events_with_bad_values(spark, folder), BAD_EVENTS, on_error="reject").rejects
    )


@query("SELECT * FROM orders")
def stage_roundtrip(spark, folder):
    """Rows staged with their schema's signature and read back."""
    orders = read(spark, folder, "orders")
    path = new_path(spark, "staged")
    lm.write_staged(orders, path)
    return plain(lm.read_staged(spark, path, orders.schema))


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props FROM events")
def micro_batch_load(spark, folder):
    """The events files as a stream, loaded batch by batch until none is left."""
    schema = read(spark, folder, "events").schema
    given = T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema
    ])
    stream = spark.readStream.schema(given).option("pathGlobFilter", "events.parquet").parquet(folder)
    table = fresh_table(spark, "stream", schema)
    running = lm.load_stream(stream, table, new_path(spark, "stream-checkpoint"), every=None)
    running.awaitTermination()
    return plain(spark.table(table))


@query(
    """SELECT event_id, user_id, value, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1"""
)
def keyed_stream_load(spark, folder):
    """The first event of each user and type, told by the stream's state; then all once more, of which nothing is new."""
    schema = read(spark, folder, "events").schema
    given = T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema
    ])
    columns = ["event_id", "user_id", "value", "event_type"]
    table = None
    for _ in range(2):
        stream = spark.readStream.schema(given).option("pathGlobFilter", "events.parquet").parquet(folder).select(*columns)
        table = table or fresh_table(spark, "keyed_stream", stream.schema)
        # another checkpoint is another stream, which learns the keys from the table
        running = lm.load_keyed_stream(
            stream, table, ["user_id", "event_type"], new_path(spark, "stream-checkpoint"), every=None,
            order_by=["event_id"], max_errors=WHATEVER,
        )
        running.awaitTermination()
    return spark.table(table)


@query(
    """SELECT event_id, user_id, value, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1"""
)
def micro_batch_upsert(spark, folder):
    """The events as a stream, upserted into a table partitioned by a key column."""
    schema = read(spark, folder, "events").schema
    given = T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema
    ])
    stream = spark.readStream.schema(given).option("pathGlobFilter", "events.parquet").parquet(folder)
    wanted = stream.select("event_id", "user_id", "value", "event_type")
    table = fresh_table(spark, "stream", wanted.schema, partition_by=["event_type"])
    running = lm.load_stream(
        wanted, table, new_path(spark, "stream-checkpoint"), every=None,
        mode="upsert", keys=["user_id", "event_type"], order_by=["event_id"],
    )
    running.awaitTermination()
    return spark.table(table)
