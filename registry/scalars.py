"""Column functions: text, numbers, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import _STOP, name_sql, raw, raw_sql
from tamiz import functions as fn
from tamiz.operators import stats
from tamiz.operators.filters import clean_numeric
from tamiz.plans.cleaning import clean_location
from tamiz.plans.dimensions import build_calendar
from tamiz.plans.profiling import with_durations

# ---- text -----------------------------------------------------------------


@query("clean_text", """
    SELECT c_custkey, nullif(upper(trim(raw)), 'NAN') AS segment FROM (
      SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN ' nan ' WHEN 'MACHINERY' THEN NULL
        ELSE '  ' || lower(c_mktsegment) || ' ' END AS raw FROM customer)""")
def _(spark, sf):
    segment = F.col("c_mktsegment")
    raw_text = (
        F.when(segment == "BUILDING", " nan ").when(segment == "MACHINERY", None)
        .otherwise(F.concat(F.lit(" \t"), F.lower(segment), F.lit(" ")))
    )
    return table(spark, sf, "customer").select("c_custkey", fn.clean_text(raw_text).alias("segment"))


@query("zero_pad_code", """
    SELECT p_partkey, CASE WHEN length(code) <= 6 THEN lpad(code, 6, '0') END AS code FROM (
      SELECT p_partkey, CAST(p_partkey * p_size * 7 AS VARCHAR) AS code FROM part)""")
def _(spark, sf):
    code = F.concat(F.lit(" "), (F.col("p_partkey") * F.col("p_size") * 7).cast("string"), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", fn.zero_pad_code(code).alias("code"))


@query("map_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FULL'
             ELSE o_orderstatus END AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '5-LOW' THEN false END AS urgent
    FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.map_values(F.col("o_orderstatus"), {"O": "OPEN", "F": "FULL"}).alias("status"),
        fn.map_values(F.col("o_orderpriority"), {"1-URGENT": True, "5-LOW": False}, default=None)
        .alias("urgent"),
    )


@query("clean_category", """
    SELECT e, count(*) AS n FROM (
      SELECT CASE upper(trim(event_type)) WHEN 'VIEW' THEN 'SEEN' WHEN 'CLICK' THEN 'SEEN'
               WHEN 'PURCHASE' THEN 'PURCHASE' END AS e FROM events) GROUP BY e""")
def _(spark, sf):
    kind = fn.clean_category(
        F.col("event_type"), ["SEEN", "PURCHASE"], {"VIEW": "SEEN", "CLICK": "SEEN"}
    )
    return table(spark, sf, "events").groupBy(kind.alias("e")).agg(F.count(F.lit(1)).alias("n"))


@query("clean_location", f"""
    SELECT nullif(upper(trim(DEPARTAMENTO)), 'NAN') AS DEPARTAMENTO, upper(trim(PROVINCIA)) AS PROVINCIA,
           upper(trim(DISTRITO)) AS DISTRITO,
           CASE WHEN length(trim(UBIGEO)) <= 6 THEN lpad(trim(UBIGEO), 6, '0') END AS UBIGEO,
           count(*) AS n
    FROM ({raw_sql('postulante')}) GROUP BY ALL""")
def _(spark, sf):
    places = clean_location(raw(spark, sf, "postulante"))
    return places.groupBy("DEPARTAMENTO", "PROVINCIA", "DISTRITO", "UBIGEO").agg(
        F.count(F.lit(1)).alias("n")
    )


_UPPER = "upper(replace(text, 'ß', 'SS'))"


@query("strip_accents", f"SELECT doc_id, md5(strip_accents({_UPPER})) AS plain FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.strip_accents(F.upper("text"))).alias("plain")
    )


def _stop_sql(expr: str) -> str:
    for word in _STOP:
        expr = f"replace({expr}, ' {word} ', ' ')"
    return expr


@query("remove_stopwords", f"SELECT doc_id, md5({_stop_sql(_UPPER)}) AS kept FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.remove_stopwords(F.upper("text"))).alias("kept")
    )


@query("collapse_spaces", r"""
    SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS flat FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.collapse_spaces(F.col("text"))).alias("flat")
    )


@query("keep_alphanumeric", rf"""
    SELECT doc_id, md5(regexp_replace({_UPPER}, '[^A-Z0-9\s]', '', 'g')) AS kept FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.keep_alphanumeric(F.upper("text"))).alias("kept")
    )


@query("normalize_career", f"""
    SELECT name, count(*) AS n FROM (SELECT {name_sql('text', _STOP)} AS name FROM documents)
    GROUP BY name""")
def _(spark, sf):
    name = fn.normalize_career(F.col("text")).alias("name")
    return table(spark, sf, "documents").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@query("normalize_career_report", f"""
    SELECT count(DISTINCT upper(trim(replace(text, 'ß', 'SS')))) AS before,
           count(DISTINCT {name_sql('text', _STOP)}) AS after FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").agg(
        F.count_distinct(fn.clean_text(F.col("text"))).alias("before"),
        F.count_distinct(fn.normalize_career(F.col("text"))).alias("after"),
    )


@query("normalize_institution", f"""
    SELECT name, count(*) AS n FROM (SELECT {name_sql('text')} AS name FROM conversations)
    GROUP BY name""")
def _(spark, sf):
    name = fn.normalize_institution(F.col("text")).alias("name")
    return table(spark, sf, "conversations").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@query("truncate_text", """
    SELECT item_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || '...' ELSE text END AS short
    FROM benchmark""")
def _(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", fn.truncate_text(F.col("text"), 60).alias("short"))


# ---- numbers --------------------------------------------------------------

_PROPS = "replace(replace(props, '{\"k\": ', ''), '}', '')"


def _props_number():
    return F.replace(F.replace(F.col("props"), F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit(""))


@query("to_number", f"""
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL
             ELSE try_cast({_PROPS} AS DOUBLE) END AS k FROM events""")
def _(spark, sf):
    number = _props_number()
    text = (
        F.when(F.col("event_type") == "error", F.concat(number, F.lit("d")))
        .when(F.col("event_type") == "view", F.lit("n.d."))
        .otherwise(F.concat(F.lit(" "), number, F.lit("\t")))
    )
    return table(spark, sf, "events").select("event_id", fn.to_number(text).alias("k"))


@query("clean_numeric", f"""
    SELECT event_id, try_cast({_PROPS} AS DOUBLE) AS k FROM events
    WHERE try_cast({_PROPS} AS DOUBLE) BETWEEN 20 AND 70""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", _props_number().alias("k"))
    return clean_numeric(events, "k", (20, 70))


@query("fill_default", """
    SELECT event_id, coalesce(nullif(event_type, 'error'), 'SIN_ESPECIFICAR') AS kind FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fn.fill_default(F.nullif("event_type", F.lit("error")), "SIN_ESPECIFICAR").alias("kind")
    )


@query("safe_ratio", """
    SELECT count(*) AS n, round(avg(r), 6) AS mean, round(median(r), 6) AS median, round(max(r), 6) AS max
    FROM (SELECT p_retailprice / CASE WHEN p_size < 5 THEN 1 ELSE p_size END AS r FROM part)""")
def _(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_retailprice", F.when(F.col("p_size") < 5, 0).otherwise(F.col("p_size")).alias("size")
    )
    out = stats.ratio_summary(parts, "p_retailprice", "size")
    return out.withColumn("n", parts.agg(F.count(F.lit(1)).alias("n")).scalar()).select(
        "n", *[F.round(m, 6).alias(m) for m in ("mean", "median", "max")]
    )


@query("round_half_even", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN (l_quantity * 125) % 10 = 5 AND (floor(l_quantity * 12.5)) % 2 = 0
                THEN floor(l_quantity * 12.5) / 100 ELSE round(l_quantity * 12.5) / 100 END AS rounded
    FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fn.round_half_even(F.col("l_quantity") * 0.125, 2).alias("rounded"),
    )


@query("percent_of", """
    SELECT o_orderpriority, CASE WHEN sum(o_totalprice) > 0
             THEN round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END)
                        / sum(o_totalprice) * 100, 6) ELSE 0 END AS pct
    FROM orders GROUP BY o_orderpriority""")
def _(spark, sf):
    full = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0))
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.round(fn.percent_of(full, F.sum("o_totalprice")), 6).alias("pct")
    )


_BINS = """CASE WHEN m <= 0 THEN NULL WHEN m <= 3 THEN '0-3 meses' WHEN m <= 6 THEN '3-6 meses'
    WHEN m <= 12 THEN '6-12 meses' WHEN m <= 24 THEN '1-2 años' WHEN m <= 36 THEN '2-3 años'
    WHEN m <= 60 THEN '3-5 años' WHEN m <= 120 THEN '5-10 años' ELSE '>10 años' END"""


@query("bin_duration", f"""
    SELECT label, count(*) AS n FROM (SELECT {_BINS} AS label FROM (
      SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 25.0 - 2.0 AS m
      FROM orders)) GROUP BY label""")
def _(spark, sf):
    days = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return table(spark, sf, "orders").groupBy(fn.bin_duration(days / 25.0 - 2.0).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


_LABELS = "['0-3 meses', '3-6 meses', '6-12 meses', '1-2 años', '2-3 años', '3-5 años', '5-10 años', '>10 años']"


@query("duration_distribution", f"""
    WITH spans AS (
      SELECT m, {_BINS} AS label FROM (SELECT round(date_diff('day', CAST(o_orderdate AS DATE),
                                  CAST(l_shipdate AS DATE)) / 30.44, 1) AS m
                     FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE m > 0)
    SELECT CAST(list_position({_LABELS}, label) AS INTEGER) AS position, label, count(*) AS n,
           round(count(*) * 100.0 / (SELECT count(*) FROM spans), 6) AS pct
    FROM spans GROUP BY label""")
def _(spark, sf):
    months = _spans(spark, sf).filter(F.col("duracion_meses") > 0)
    return stats.duration_distribution(months, "duracion_meses").withColumn("pct", F.round("pct", 6))


_EXPERIENCE = """CASE WHEN f = 'SI' THEN '0. Sin experiencia' WHEN t IS NULL THEN '5. Datos inválidos'
    WHEN u = 'AÑOS' THEN CASE WHEN t <= 1 THEN '1. Hasta 1 año' WHEN t <= 2 THEN '2. 1-2 años'
      WHEN t <= 5 THEN '3. 2-5 años' ELSE '4. Más de 5 años' END
    WHEN u = 'MESES' THEN CASE WHEN t <= 12 THEN '1. Hasta 1 año' WHEN t <= 24 THEN '2. 1-2 años'
      WHEN t <= 60 THEN '3. 2-5 años' ELSE '4. Más de 5 años' END
    ELSE '1. Hasta 1 año' END"""


@query("categorize_experience", f"""
    SELECT category, count(*) AS n FROM (SELECT {_EXPERIENCE} AS category FROM (
      SELECT upper(SINEXPERIENCIA) AS f, try_cast(TIEMPOEXPERIENCIA AS DOUBLE) AS t,
             upper(TIPOTIEMPOEXPERIENCIA) AS u FROM ({raw_sql('vacantes')}))) GROUP BY category""")
def _(spark, sf):
    vacancies = raw(spark, sf, "vacantes")
    category = fn.categorize_experience(
        F.upper("SINEXPERIENCIA"), F.col("TIEMPOEXPERIENCIA"), F.col("TIPOTIEMPOEXPERIENCIA")
    )
    return vacancies.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))


# ---- dates ----------------------------------------------------------------

@query("parse_dates", f"""
    SELECT AVISOID, _row_order,
           CAST(coalesce(try_strptime(FECHAINICIO, '%Y-%m-%d'), try_strptime(FECHAINICIO, '%d/%m/%Y')) AS VARCHAR) AS inicio,
           CAST(coalesce(try_strptime(FECHAFIN, '%Y-%m-%d'), try_strptime(FECHAFIN, '%d/%m/%Y')) AS VARCHAR) AS fin,
           CAST(coalesce(try_strptime(FECHACREACION, '%Y-%m-%d'), try_strptime(FECHACREACION, '%d/%m/%Y')) AS VARCHAR) AS creacion
    FROM ({raw_sql('vacantes')})""")
def _(spark, sf):
    return raw(spark, sf, "vacantes").select(
        "AVISOID", "_row_order",
        *[fn.parse_dates(F.col(f"FECHA{c.upper()}")).cast("string").alias(c)
          for c in ("inicio", "fin", "creacion")],
    )


@query("parse_dates_report", f"""
    SELECT count(*) AS rows, count(FECHACREACION) AS non_null,
           count(try_strptime(FECHACREACION, '%Y-%m-%d')) AS parsed,
           round(count(try_strptime(FECHACREACION, '%Y-%m-%d')) * 100.0 / count(*), 6) AS pct_parsed
    FROM ({raw_sql('vacantes')})""")
def _(spark, sf):
    out = stats.date_parse_report(
        raw(spark, sf, "vacantes"), "FECHACREACION", fn.parse_dates(F.col("FECHACREACION"))
    )
    return out.withColumn("pct_parsed", F.round("pct_parsed", 6))


_SPELLED = """CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y.%m.%d 10:30')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%m-%d-%Y')
    WHEN '4-NOT SPECIFIED' THEN 'sin fecha' ELSE strftime(o_orderdate, '%Y%m%d') END"""


@query("parse_mixed_dates", f"""
    SELECT o_orderkey, CAST(coalesce(
             try_strptime(d, '%Y.%m.%d %H:%M'), try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%m-%d-%Y'),
             try_strptime(d, '%d/%m/%Y'), try_strptime(d, '%Y%m%d')) AS VARCHAR) AS parsed
    FROM (SELECT o_orderkey, {_SPELLED} AS d FROM orders)""")
def _(spark, sf):
    """Five spellings in one column, two of them ambiguous, read month first."""
    priority = F.col("o_orderpriority")
    spelled = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyy.MM.dd' 10:30'"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "MM-dd-yyyy"))
        .when(priority == "4-NOT SPECIFIED", "sin fecha")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.parse_mixed_dates(spelled).cast("string").alias("parsed")
    )


@query("truncate_day", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY 1""")
def _(spark, sf):
    day = fn.truncate_day(F.col("ts")).cast("string").alias("day")
    return table(spark, sf, "events").groupBy(day).agg(F.count(F.lit(1)).alias("n"))


_CALENDAR = """CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes,
    CAST(day(d) AS INTEGER) AS dia, CAST(quarter(d) AS INTEGER) AS trimestre,
    CAST(CASE WHEN quarter(d) <= 2 THEN 1 ELSE 2 END AS INTEGER) AS semestre,
    CAST(isodow(d) AS INTEGER) AS dia_semana,
    ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',
     'Noviembre','Diciembre'][month(d)] AS nombre_mes,
    ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(d)] AS nombre_dia,
    isodow(d) >= 6 AS es_fin_semana"""


@query("calendar_attributes", f"""
    SELECT o_orderkey, {_CALENDAR} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(spark, sf):
    columns = fn.calendar_attributes(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(name) for name, c in columns.items()]
    )


@query("build_calendar", f"""
    SELECT row_number() OVER (ORDER BY d) AS fecha_sk, CAST(d AS VARCHAR) AS fecha, {_CALENDAR}
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)""")
def _(spark, sf):
    days = table(spark, sf, "events").select(F.col("ts").cast("date").alias("fecha")).distinct()
    return build_calendar(days).withColumn("fecha", F.col("fecha").cast("string"))


def _spans(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("o_orderdate").alias("FECHAINICIO"), F.col("l_shipdate").alias("FECHAFIN"),
    )
    return with_durations(joined)


_DAYS = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"


@query("duration", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST({_DAYS} AS INTEGER) AS duracion_dias,
           round({_DAYS} / 30.44, 1) AS duracion_meses, round({_DAYS} / 365.25, 2) AS duracion_anos
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(spark, sf):
    return _spans(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "duracion_dias", "duracion_meses", "duracion_anos"
    )


@query("duration_summary", f"""
    SELECT count(*) AS count, CAST(min(d) AS DOUBLE) AS min, CAST(max(d) AS DOUBLE) AS max,
           round(avg(d), 6) AS mean, median(d) AS median
    FROM (SELECT {_DAYS} AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE d > 0""")
def _(spark, sf):
    out = stats.duration_summary(_spans(spark, sf), "duracion_dias")
    return out.withColumn("mean", F.round("mean", 6))
