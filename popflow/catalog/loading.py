"""Queries on sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import Roles
from popflow.functions import text
from popflow.sources import census, files, listing, microdata
from popflow.session import cut, new_path
from popflow.specs import PUMS_HH, STATES


@query("sentinel_fill", f"SELECT {', '.join(PUMS_HH)} FROM hh")
def sentinel_fill(t: Roles) -> DataFrame:
    return microdata.fill_sentinel(t.hh_raw(), PUMS_HH)


@query("try_numeric", """
SELECT c_custkey AS whole, c_acctbal AS number, c_name AS word,
       nullif(c_mktsegment, 'BUILDING') AS gap FROM customer""")
def try_numeric(t: Roles) -> DataFrame:
    texts = t.table("customer").select(
        F.col("c_custkey").cast("string").alias("whole"),
        F.col("c_acctbal").cast("string").alias("number"),
        F.col("c_name").alias("word"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("gap"))
    return census.best_effort_numeric(texts)


@query("natural_rejoin", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders""")
def natural_rejoin(t: Roles) -> DataFrame:
    fields = ["o_totalprice", "o_orderstatus", "o_orderpriority"]
    keys = ["o_orderkey", "o_custkey"]
    groups = census.field_chunks([*fields, *keys], 2, keys)
    return census.natural_rejoin([t.table("orders").select(*g) for g in groups]).select(
        *keys, *fields)


@query("incremental_new_keys", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def incremental_new_keys(t: Roles) -> DataFrame:
    incoming = t.table("orders").select("o_orderkey", "o_totalprice")
    cached = t.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return microdata.new_rows(incoming, cached, "o_orderkey")


@query("cache_versions", """
SELECT 2 AS version, SERIALNO, ST, WGTP, NULL AS NP FROM hh_raw
UNION ALL SELECT 3, SERIALNO, ST, WGTP, NP FROM hh_raw""")
def cache_versions(t: Roles) -> DataFrame:
    """A cache begun with two states, given the others, asked again in vain, and rebuilt with one
    more column; beside it lies what a stopped job has written."""
    raw = t.hh_raw().select("SERIALNO", "ST", "WGTP", "NP")
    path = new_path(t.spark)
    some = raw.drop("NP")
    microdata.append_states(t.spark, some.filter("ST <= 2"), path, cached=False)
    for _ in range(2):
        microdata.append_states(t.spark, some, path)
    microdata.append_states(t.spark, raw, path)
    raw.withColumn("WGTP", F.lit(-1)).write.partitionBy("ST").parquet(f"{path}/parts/part=stopped")
    second = microdata.read_cache(t.spark, path, 2).withColumn(
        "NP", F.lit(None).cast(raw.schema["NP"].dataType))
    return second.withColumn("version", F.lit(2)).unionByName(
        microdata.read_cache(t.spark, path).withColumn("version", F.lit(3))).select(
            "version", "SERIALNO", F.col("ST").cast("bigint").alias("ST"), "WGTP", "NP")


@query("coverage_gaps", """
SELECT count(*) AS n_missing_keys, 'o_clerk' AS missing_columns, false AS complete
FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders))""")
def coverage_gaps(t: Roles) -> DataFrame:
    cached = t.table("orders").withColumnRenamed("o_custkey", "c_custkey")
    report = microdata.coverage(
        cached, t.table("customer"), "c_custkey", ["o_totalprice", "o_clerk"])
    return report.withColumn("missing_columns", F.array_join("missing_columns", ","))


def _payload(*cells: str) -> F.Column:
    """A two-row document: header names and one row of values."""
    header = ",".join(f'"{c}"' for c in cells)
    values = F.concat_ws('","', *[F.col(c).cast("string") for c in cells])
    return F.concat(F.lit(f'[[{header}],["'), values, F.lit('"]]'))


def _events(t: Roles) -> DataFrame:
    return t.table("events").withColumn("k", F.get_json_object("props", "$.k"))


@query("json_table", """
SELECT event_id, CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) AS k, event_type
FROM events""")
def json_table(t: Roles) -> DataFrame:
    documents = _events(t).select(_payload("event_id", "k", "event_type").alias("value"))
    return census.json_table(
        documents, "value", {"event_id": "bigint", "k": "bigint", "event_type": "string"})


@query("json_chunks_rejoined", """
SELECT event_id, user_id, CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) AS k, value
FROM events""")
def json_chunks_rejoined(t: Roles) -> DataFrame:
    events = _events(t)
    first = census.json_table(
        events.select(_payload("event_id", "user_id", "k").alias("d")), "d",
        {"event_id": "bigint", "user_id": "bigint", "k": "bigint"})
    second = census.json_table(
        events.select(_payload("event_id", "user_id", "value").alias("d")), "d",
        {"event_id": "bigint", "user_id": "bigint", "value": "double"})
    return census.natural_rejoin([first, second]).select("event_id", "user_id", "k", "value")


_LINKS = r"""
SELECT url, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1)) AS href
FROM pages"""


@query("link_listing", _LINKS)
def link_listing(t: Roles) -> DataFrame:
    return listing.links(t.table("pages"))


@query("file_name_parse", rf"""
WITH links AS ({_LINKS}),
named AS (SELECT url, href, regexp_replace(href, '([^/])\.[^./]*$', '\1') AS stem FROM links)
SELECT url, href, stem, lower(right(stem, 2)) AS tail, split_part(stem, '/', 2) AS first_piece,
       rtrim(href) LIKE '%s' AS ends_s
FROM named""")
def file_name_parse(t: Roles) -> DataFrame:
    stem = text.strip_extension("href")
    return listing.links(t.table("pages")).select(
        "url", "href", stem.alias("stem"), F.lower(F.right(stem, F.lit(2))).alias("tail"),
        F.coalesce(text.name_piece(stem, 2, "/"), F.lit("")).alias("first_piece"),
        F.endswith(F.rtrim("href"), F.lit("s")).alias("ends_s"))


_ABBR = ["AL", "AK", "AZ", "CA", "CT", "DC", "FL", "ID", "KS", "ME", "NE", "NY"]  # wanted
_FIPS = [f for f, a, _ in STATES if a in _ABBR]
_FILES = """found AS (
  SELECT 'https://example.org/' || c_mktsegment AS url,
         CASE WHEN c_acctbal < 0 THEN 'readme_' || c_custkey || '.txt'
              WHEN c_acctbal < 500 THEN 'tl_' || c_custkey || '.zip'
              ELSE 'tl_2021_' || lpad(CAST(1 + c_custkey % 30 AS VARCHAR), 2, '0') || '_bg.zip'
         END AS href FROM customer)"""


def _boundary_listing(t: Roles) -> DataFrame:
    state = F.lpad((1 + F.col("c_custkey") % 30).cast("string"), 2, "0")
    return t.table("customer").select(
        F.concat(F.lit("https://example.org/"), "c_mktsegment").alias("url"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("readme_"), "c_custkey", F.lit(".txt")))
        .when(F.col("c_acctbal") < 500, F.concat(F.lit("tl_"), "c_custkey", F.lit(".zip")))
        .otherwise(F.concat(F.lit("tl_2021_"), state, F.lit("_bg.zip"))).alias("href"))


@query("listing_boundary_files", f"""
WITH {_FILES}
SELECT substr(href, 9, 2) AS fips, 'raw/shp/' || href AS path, url || '/' || href AS file_url,
       'bg' AS level FROM found
WHERE href LIKE 'tl_2021_%.zip' AND substr(href, 9, 2) IN ({", ".join(f"'{f}'" for f in _FIPS)})
""")
def listing_boundary_files(t: Roles) -> DataFrame:
    return listing.geography_files(_boundary_listing(t), _FIPS, "raw/shp")


@query("listing_microdata_files", f"""
WITH s(fips, abbr) AS (VALUES {", ".join(f"('{f}', '{a}')" for f, a, _ in STATES if a in _ABBR)}),
found AS (
  SELECT 'https://example.org/' || o_orderstatus AS url,
         CASE WHEN o_totalprice < 100000 THEN 'notes.pdf'
              ELSE 'csv_' || CASE WHEN o_orderstatus = 'F' THEN 'h' ELSE 'p' END
                   || lower(substr('ALAKAZARCACOXX', CAST(1 + 2 * (o_custkey % 7) AS INTEGER), 2))
                   || '.zip' END AS href FROM orders)
SELECT fips, 'raw/csv/' || href AS path, url || '/' || href AS file_url,
       CASE WHEN substr(href, 5, 1) = 'h' THEN 'hh' ELSE 'per' END AS level
FROM found JOIN s ON s.abbr = upper(substr(href, 6, 2)) WHERE href LIKE '%.zip'""")
def listing_microdata_files(t: Roles) -> DataFrame:
    start = (1 + 2 * (F.col("o_custkey") % 7)).cast("int")
    state = F.lower(F.substr(F.lit("ALAKAZARCACOXX"), start, F.lit(2)))
    kind = F.when(F.col("o_orderstatus") == "F", "h").otherwise("p")
    found = t.table("orders").select(
        F.concat(F.lit("https://example.org/"), "o_orderstatus").alias("url"),
        F.when(F.col("o_totalprice") < 100000, "notes.pdf")
        .otherwise(F.concat(F.lit("csv_"), kind, state, F.lit(".zip"))).alias("href"))
    return listing.microdata_files(found, listing.state_lookup(t.spark), _ABBR, "raw/csv")


@query("expression_first_field", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE p_type END AS field FROM part""")
def expression_first_field(t: Roles) -> DataFrame:
    plain = F.concat(F.lit("(persons."), "p_type", F.lit(" <= 4) & (persons.B > 0)"))
    quoted = F.concat(F.lit("(persons.'"), "p_type", F.lit("' <= 4)"))
    none = F.concat("p_type", F.lit(" <= 4"))
    size = F.col("p_size")
    expression = F.when(size > 25, none).when(size > 12, quoted).otherwise(plain)
    return t.table("part").select("p_partkey", text.first_field(expression).alias("field"))


@query("summary_key", """
SELECT c_custkey, c_mktsegment || '_PUMA' AS geography FROM customer""")
def summary_key(t: Roles) -> DataFrame:
    path = F.concat(F.lit("out/final_summary_"), "c_mktsegment", F.lit("_PUMA.csv"))
    return t.table("customer").select("c_custkey", text.summary_geography(path).alias("geography"))


@query("union_states", """
SELECT s_nationkey AS state, s_suppkey AS id, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL
SELECT c_nationkey, c_custkey, c_acctbal, c_mktsegment FROM customer""")
def union_states(t: Roles) -> DataFrame:
    suppliers = t.table("supplier").select(
        F.col("s_nationkey").alias("state"), F.col("s_suppkey").alias("id"),
        F.col("s_acctbal").alias("balance"))
    customers = t.table("customer").select(
        F.col("c_nationkey").alias("state"), F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return files.union_tables([suppliers, customers]).select("state", "id", "balance", "segment")


@query("missing_states", """
SELECT DISTINCT o_custkey AS state FROM orders
WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def missing_states(t: Roles) -> DataFrame:
    present = t.table("supplier").select(F.col("s_suppkey").alias("state"))
    return files.missing_states(
        present, t.table("orders").select(F.col("o_custkey").alias("state")))


# --- files written to the shared folder and read back -----------------------
@query("microdata_csv", f"SELECT {', '.join(PUMS_HH)} FROM hh")
def microdata_csv(t: Roles) -> DataFrame:
    """Two files with their columns in opposite order, read by name."""
    raw = t.hh_raw().select(*[F.col(c).cast(k).alias(c) for c, k in PUMS_HH.items()])
    paths = []
    for part, columns in ((0, list(PUMS_HH)), (1, list(PUMS_HH)[::-1])):
        paths.append(new_path(raw.sparkSession))
        chosen = raw.filter(F.pmod(F.xxhash64("SERIALNO"), F.lit(2)) == part)
        files.write_csv(chosen.select(*columns), paths[-1])
    return microdata.read_microdata(raw.sparkSession, paths, PUMS_HH)


@query("named_inputs", "WITH names(name) AS (VALUES " + ", ".join(
    f"('{name}')" for name in files.INPUT_FILES) + """)
SELECT name, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS id_sum
FROM names, customer GROUP BY name""")
def named_inputs(t: Roles) -> DataFrame:
    """All named tables of a folder, with input columns renamed."""
    customer = t.table("customer").select(F.col("c_custkey").alias("hhnum"))
    folder = new_path(customer.sparkSession)
    files.write_tables({f: customer for f in files.INPUT_FILES.values()}, folder)
    tables = files.read_inputs(customer.sparkSession, folder)
    return files.union_tables([
        files.map_inputs(df).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("hh_id").alias("id_sum"))
        .select(F.lit(name).alias("name"), "n_rows", "id_sum") for name, df in tables.items()])


@query("combined_states", """
SELECT STATE, BG, H_TOTAL, P_TOTAL FROM bg_controls WHERE STATE <> 3
UNION ALL SELECT 3, NULL, NULL, NULL""")
def combined_states(t: Roles) -> DataFrame:
    """Block groups of the states' folders, whose columns differ in order; state 3 has no file."""
    bg = cut(t.prepared("BG")["BG"].select("STATE", "BG", "H_TOTAL", "P_TOTAL"))
    root, name = new_path(t.spark), files.INPUT_FILES["BG"]
    for state in (1, 2, 4, 5):
        columns = bg.columns if state % 2 else bg.columns[::-1]
        files.write_csv(bg.filter(F.col("STATE") == state).select(*columns),
                        f"{root}/{state}/{name}")
    files.write_csv(bg.select("BG"), f"{root}/9/{name}")  # not asked for
    got, missing = files.combine_states(t.spark, root, name, [str(s) for s in range(1, 6)])
    return got.select(*bg.columns).unionByName(
        missing.select(F.col("state").cast("bigint").alias("STATE")), allowMissingColumns=True)


@query("summaries_by_file", """
SELECT 'BG' AS geography, c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS a_control,
       c_acctbal AS a_result, NULL AS b_control FROM customer
UNION ALL SELECT 'BG_PUMA', c_nationkey, count(*), round(sum(c_acctbal), 2), NULL FROM customer
GROUP BY c_nationkey
UNION ALL SELECT 'TRACT', s_suppkey, NULL, s_acctbal, s_nationkey FROM supplier""")
def summaries_by_file(t: Roles) -> DataFrame:
    """Summaries written as files and read by geography, two of them with one header."""
    tables = {
        "BG": t.table("customer").selectExpr(
            "c_custkey AS id", "c_nationkey AS a_control", "c_acctbal AS a_result"),
        "BG_PUMA": t.table("customer").groupBy(F.col("c_nationkey").alias("id")).agg(
            F.count(F.lit(1)).alias("a_control"), F.round(F.sum("c_acctbal"), 2).alias("a_result")),
        "TRACT": t.table("supplier").selectExpr(
            "s_acctbal AS a_result", "s_suppkey AS id", "s_nationkey AS b_control")}
    folder = new_path(t.spark)
    files.write_tables({f"final_summary_{geo}.csv": df for geo, df in tables.items()}, folder)
    found = files.read_summaries(t.spark, folder, list(tables))
    return files.union_tables([
        found[geo].withColumn("geography", F.lit(geo)) for geo in tables]).select(
            "geography", "id", "a_control", "a_result", "b_control")


@query("projection_and_casts", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
       'o_custkey,o_orderstatus,o_totalprice,o_orderkey' AS column_order FROM orders""")
def projection_and_casts(t: Roles) -> DataFrame:
    """Undeclared columns first, declared ones cast from text."""
    texts = t.table("orders").select(*[F.col(c).cast("string").alias(c) for c in (
        "o_totalprice", "o_orderkey", "o_orderstatus", "o_custkey")])
    typed = census.cast_columns(
        texts, {"o_totalprice": "double", "o_orderkey": "bigint", "o_custkey": "bigint",
                "absent": "int"})
    ordered = census.extras_first(typed, ["o_totalprice", "o_orderkey"])
    return ordered.withColumn("column_order", F.lit(",".join(ordered.columns)))
