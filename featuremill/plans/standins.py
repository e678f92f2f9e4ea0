"""Domain roles played by the driver's tables.

The operators are written for business / check-in / tip / review / user / label tables.
The benchmark data is a TPC-H-like star schema, so each role is derived from it by one
SELECT. The same SELECT text runs on Spark (direct parquet paths) and on DuckDB (the
oracle's views), so both engines see identical inputs; only two date expressions differ
by dialect. Token attributes are spread over the rows by residues of the key (one array
lookup per column), and nulls are made the same way or with CASE, because the source
tables hold no nulls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class Dialect:
    name: str

    def table(self, t: str, sf_dir: str | None) -> str:
        if self.name == "spark":
            return f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`"
        return t

    def ts_text(self, e: str) -> str:
        if self.name == "spark":
            return f"date_format({e}, 'yyyy-MM-dd HH:mm:ss')"
        return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"

    def day_text(self, base: str, n: str) -> str:
        if self.name == "spark":
            return f"date_format(date_add(DATE '{base}', CAST(({n}) AS INT)), 'yyyy-MM-dd')"
        return f"strftime(DATE '{base}' + CAST(({n}) AS INTEGER), '%Y-%m-%d')"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")


def _lit(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _pick(d: Dialect, key: str, m: int, values: list) -> str:
    """``values[key % m]`` (residues past the list give NULL), as one array lookup."""
    vals = list(values) + [None] * (m - len(values))
    if all(v is None for v in vals):
        return "CAST(NULL AS STRING)"
    items = ", ".join(_lit(v) for v in vals)
    if d.name == "spark":
        return f"element_at(array({items}), CAST({key} % {m} AS INT) + 1)"
    return f"[{items}][CAST({key} % {m} AS INTEGER) + 1]"


# Token vocabularies of the raw attribute columns (as the source spells them).
_BOOL3 = ["True", "False", None]
# Attribute -> (residue, spellings in the source).
_ATTRIBUTES = {
    "attributes_RestaurantsDelivery": (10, ["True", "False", "None", None, "False", "False",
                                            "False", "False", "False", "False"]),
    "attributes_RestaurantsTakeOut": (11, ["True", "None", None] + ["False"] * 8),
    "attributes_Alcohol": (9, ["None", "u'none'", "'none'", None, "u'full_bar'", "'full_bar'",
                               "u'beer_and_wine'", "'beer_and_wine'", "unknown"]),
    "attributes_Ambience": (4, ["{'romantic': False, 'casual': True}", "{'romantic': False}",
                                None, "None"]),
    "attributes_BikeParking": (3, _BOOL3),
    "attributes_BusinessAcceptsCreditCards": (4, ["True", "False", None, "None"]),
    "attributes_BusinessParking": (5, ["{'garage': False, 'street': True}", "{'garage': False}",
                                       None, "None", "{'lot': True}"]),
    "attributes_ByAppointmentOnly": (5, ["True", "False", None, "None", "abc"]),
    "attributes_GoodForKids": (3, ["True", None, "False"]),
    "attributes_HasTV": (6, ["True", "False", None, "None", "True", ""]),
    "attributes_OutdoorSeating": (7, ["True", "False", None, "None", "True", "False", "True"]),
    "attributes_RestaurantsAttire": (8, ["None", "u'casual'", "'casual'", "u'dressy'", "'dressy'",
                                         "u'formal'", "'formal'", None]),
    "attributes_RestaurantsGoodForGroups": (3, ["False", "True", None]),
    "attributes_RestaurantsPriceRange2": (6, ["1", "2", "3", "4", "None", None]),
    "attributes_RestaurantsReservations": (4, ["True", "False", None, "False"]),
    "attributes_WiFi": (8, ["None", "u'no'", "'no'", "u'free'", "'free'", "u'paid'", "'paid'",
                            None]),
    # mostly missing: removed by the null-share filter
    "attributes_Music": (5, ["{'live': True}"]),
}
_SEGMENT_CATEGORIES = {
    "AUTOMOBILE": "Automotive, Auto Parts & Supplies",
    "BUILDING": "Home Services,Contractors, Food",
    "FURNITURE": "Shopping, Home & Garden",
    "HOUSEHOLD": "Restaurants, Pizza, Italian, Bars, Nightlife, Sandwiches, Desserts",
    "MACHINERY": "Local Services, Professional Services, Machine Shops, Bakeries, Cafes",
}
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def business_columns() -> list:
    """Column names of the business stand-in, in order."""
    return (["business_id", "name", "address", "city", "state", "postal_code", "latitude",
             "longitude", "is_open", "categories"] + list(_ATTRIBUTES)
            + [f"hours_{day}" for day in DAYS])


def business_sql(d: Dialect, sf_dir: str | None = None, dealt: bool = False) -> str:
    """``dealt`` (Spark): the customers are dealt out to the tasks before the wide columns are made
    of them; their file is small and would be one task's work."""
    customer = d.table('customer', sf_dir)
    if dealt:
        customer = f"(SELECT /*+ REPARTITION */ c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer})"
    seg = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SEGMENT_CATEGORIES.items())
    attrs = ",\n  ".join(f"{_pick(d, 'c.c_custkey', m, vals)} AS {name}"
                         for name, (m, vals) in _ATTRIBUTES.items())
    hours = ",\n  ".join(
        f"{_pick(d, f'(c.c_custkey + {i})', 3, ['0:0-0:0', '9:0-17:0', None])} AS hours_{day}"
        for i, day in enumerate(DAYS))
    return f"""SELECT c.c_custkey AS business_id,
  c.c_name AS name,
  concat(CAST(c.c_custkey AS STRING), ' Main St') AS address,
  n.n_name AS city,
  CAST(n.n_regionkey AS STRING) AS state,
  CAST(c.c_custkey + 10000 AS STRING) AS postal_code,
  c.c_acctbal / 100.0 AS latitude,
  -c.c_acctbal / 100.0 AS longitude,
  CASE WHEN c.c_acctbal >= 0 THEN 1 ELSE 0 END AS is_open,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL WHEN c.c_custkey % 29 = 0 THEN ''
       ELSE CASE c.c_mktsegment {seg} END END AS categories,
  {attrs},
  {hours}
FROM {customer} c JOIN {d.table('nation', sf_dir)} n
  ON c.c_nationkey = n.n_nationkey"""


def label_sql(d: Dialect, sf_dir: str | None = None) -> str:
    """(business_id, label text) of every order; TRUE when its status is P. Holds duplicate
    pairs and businesses with both labels."""
    return f"""SELECT o_custkey AS business_id,
  CASE WHEN o_orderstatus = 'P' THEN 'TRUE' ELSE 'FALSE' END AS delivery_or_takeout
FROM {d.table('orders', sf_dir)}"""


def checkin_sql(d: Dialect, sf_dir: str | None = None) -> str:
    return f"""SELECT o_custkey AS business_id, {d.ts_text('o_orderdate')} AS date
FROM {d.table('orders', sf_dir)}"""


def tip_sql(d: Dialect, sf_dir: str | None = None) -> str:
    return f"""SELECT user_id AS business_id, event_id AS user_id, {d.ts_text('ts')} AS date,
  CASE WHEN event_type = 'error' THEN 'n/a'
       ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS compliment_count
FROM {d.table('events', sf_dir)}"""


def review_sql(d: Dialect, sf_dir: str | None = None) -> str:
    return f"""SELECT concat(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING))
    AS review_id,
  o.o_custkey AS business_id,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_suppkey END AS user_id,
  CASE WHEN l.l_quantity > 49 THEN NULL ELSE l.l_quantity END AS stars,
  CAST(l.l_linenumber AS BIGINT) AS useful,
  CAST(round(100 * l.l_discount) AS BIGINT) AS funny,
  CAST(round(100 * l.l_tax) AS BIGINT) AS cool
FROM {d.table('lineitem', sf_dir)} l JOIN {d.table('orders', sf_dir)} o
  ON l.l_orderkey = o.o_orderkey"""


# A declared vocabulary of city names for the wide layout.
CITIES = tuple(f"NATION_{i}" for i in range(25))

# Compliment columns of the user table.
COMPLIMENTS = ("compliment_cool", "compliment_cute", "compliment_funny", "compliment_hot",
               "compliment_list", "compliment_more", "compliment_note", "compliment_photos",
               "compliment_plain", "compliment_profile", "compliment_writer")


def user_sql(d: Dialect, sf_dir: str | None = None) -> str:
    comp = ",\n  ".join(f"(s_suppkey + {i}) % {i + 2} AS {c}" for i, c in enumerate(COMPLIMENTS))
    since = d.day_text("2005-01-01", "s_suppkey * 37 % 5000")
    elite = _pick(d, "s_suppkey", 5, ["", "None", "2015", "2015,2016,2017"])
    return f"""SELECT s_suppkey AS user_id, s_name AS name,
  CAST(floor(abs(s_acctbal) / 100) AS BIGINT) AS review_count,
  CAST(s_nationkey % 5 AS DOUBLE) + 0.5 AS average_stars,
  CAST(s_nationkey AS BIGINT) AS fans,
  s_suppkey % 7 AS useful, s_suppkey % 5 AS funny, s_suppkey % 3 AS cool,
  {comp},
  concat({since}, ' 08:30:00') AS since,
  {elite} AS elite,
  CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'u1'
       ELSE concat('u1,u', CAST(s_nationkey AS STRING), ',u', CAST(s_suppkey AS STRING)) END
    AS friends
FROM {d.table('supplier', sf_dir)}"""


def model_sql(d: Dialect, sf_dir: str | None = None) -> str:
    """Documents with a quality label: a small numeric/categorical model table."""
    return f"""SELECT dd.doc_id, dd.n_chars, dd.lang, dd.source, l.quality AS target
FROM {d.table('documents', sf_dir)} dd JOIN {d.table('labels', sf_dir)} l
  ON dd.doc_id = l.doc_id"""


ROLES = {
    "business": business_sql,
    "label": label_sql,
    "checkin": checkin_sql,
    "tip": tip_sql,
    "review": review_sql,
    "user": user_sql,
    "model": model_sql,
}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in table for one role, as a lazy Spark DataFrame."""
    return spark.sql(ROLES[name](SPARK, sf_dir))


def role_sql(name: str) -> str:
    """The same stand-in as a parenthesised DuckDB subquery."""
    return "(" + ROLES[name](DUCKDB) + ")"


def raw_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business stand-in with the source's dotted names (``attributes.WiFi``)."""
    df = spark.sql(business_sql(SPARK, sf_dir, dealt=True))
    return df.toDF(*[c.replace("attributes_", "attributes.", 1).replace("hours_", "hours.", 1)
                     for c in df.columns])
