"""Business (entity) features: the composite of split/flag, null-share column filter,
row filters, token one-hots, frequent-value one-hot and schedule classes.

Two steps depend on the data (which columns survive the null filter, which cities are
frequent). ``fit_entity_features`` runs those two bounded actions once and returns an
``EntityFeaturesModel``; ``transform`` is then lazy and gives the same columns on any
table of the same shape (train, test, next month's data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.functions.predicates import flag_set, isin_any, not_true
from featuremill.operators.encode import (FrequentCategorySpec, FrequentOneHotSpec,
                                          TokenGroup, _flag, fit_frequent_category,
                                          frequent_one_hot_spec, one_hot_columns,
                                          quoted_variants, sentinel_class_columns,
                                          split_columns, true_flag_columns)
from featuremill.operators.profile import NullFilterSpec, fit_null_filter
from featuremill.session import scratch_path
from featuremill.sources.files import sanitize_columns

# Categories that mark a leisure business (checked against the first five
# listed categories), in their original order.
LEISURE_CATEGORIES = [
    "Restaurants", "Food", "Shopping", "Nightlife", "Active Life", "Pizza", "Fast Food", "Bars",
    "Coffee & Tea", "Sandwiches", "Arts & Entertainment", "Mexican", "Hotels & Travel",
    "American (Traditional)", "Italian", "Chinese", "Breakfast & Brunch", "Burgers", "Bakeries",
    "American (New)", "Specialty Food", "Grocery", "Sushi Bars", "Desserts",
    "Ice Cream & Frozen Yogurt", "Japanese", "Hotels", "Cafes", "Seafood", "Beer", "Thai",
    "Vietnamese", "Salad", "Chicken Wings", "Sports Bars", "Diners", "Delis", "Mediterranean",
    "Pubs", "Indian", "Asian Fusion", "Juice Bars & Smoothies", "Barbeque", "Local Flavor",
    "Steakhouses", "Greek", "Lounges", "Middle Eastern", "Korean", "Wine & Spirits",
    "Caribbean", "Donuts", "Chicken Shop", "French", "Comfort Food", "Latin American",
    "Breweries", "Tex-Mex", "Tapas/Small Plates", "Portuguese", "Hookah Bars", "Gastropubs",
    "Spanish", "Hookah Bars", "Gay Bars", "Cupcakes", "Tapas Bars", "Chocolatiers & Shops",
    "Fish & Chips", "African", "Halal", "Waffles", "Tacos", "Creperies", "Beer Bar", "Ramen",
    "Turkish", "Cheese Shops", "Butcher", "Brazilian", "Buffets", "Vegan", "Cocktail Bars",
    "Hot Dogs", "Bagels", "Dim Sum", "Cajun/Creole", "Cantonese", "Bistros", "Lebanese", "Poke",
    "Falafel", "Donairs", "Peruvian", "Empanadas", "Cuban", "Dominican", "Venezuelan",
    "Colombian", "Puerto Rican", "Food Stands", "Patisserie/Cake Shop", "Soup", "Custom Cakes",
    "Noodles", "Food Trucks", "Fruits & Veggies", "Canadian (New)", "Moroccan",
]

# Token groups of the multi-valued attributes. ``null_in`` marks the group
# that also takes a missing value.
ALCOHOL = [TokenGroup("alcohol_none", ("None",) + quoted_variants("none"), null_in=True),
           TokenGroup("alcohol_full_bar", quoted_variants("full_bar")),
           TokenGroup("alcohol_beer_and_wine", quoted_variants("beer_and_wine"))]
ATTIRE = [TokenGroup("attire_null", (), null_in=True),
          TokenGroup("attire_none", ("None",)),
          TokenGroup("attire_casual", quoted_variants("casual")),
          TokenGroup("attire_dressy", quoted_variants("dressy")),
          TokenGroup("attire_formal", quoted_variants("formal"))]
PRICE = [TokenGroup("rest_price_range_none", ("None",), null_in=True),
         TokenGroup("rest_price_range_1", ("1",)), TokenGroup("rest_price_range_2", ("2",)),
         TokenGroup("rest_price_range_3", ("3",)), TokenGroup("rest_price_range_4", ("4",))]
WIFI = [TokenGroup("wifi_none", ("None",), null_in=True),
        TokenGroup("wifi_no", quoted_variants("no")),
        TokenGroup("wifi_free", quoted_variants("free")),
        TokenGroup("wifi_paid", quoted_variants("paid"))]
# Attribute -> (output, output for "missing" or None).
TRUE_FLAGS = {
    "attributes_BikeParking": ("bikeParking", None),
    "attributes_BusinessAcceptsCreditCards": ("acceptsCreditCard", "acceptCC_null"),
    "attributes_ByAppointmentOnly": ("appointment", None),
    "attributes_GoodForKids": ("goodForKids", "goodForKids_null"),
    "attributes_HasTV": ("hasTv", "hasTv_null"),
    "attributes_OutdoorSeating": ("outdoorSeating", None),
    "attributes_RestaurantsGoodForGroups": ("goodForGroups", None),
    "attributes_RestaurantsReservations": ("caters", None),
}
CONTAINS_FLAGS = {"attributes_Ambience": "ambience", "attributes_BusinessParking": "businessParking"}
TOKEN_GROUPS = {"attributes_Alcohol": ALCOHOL, "attributes_RestaurantsAttire": ATTIRE,
                "attributes_RestaurantsPriceRange2": PRICE, "attributes_WiFi": WIFI}
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
ALL_DAY = "0:0-0:0"
NULL_SHARE_LIMIT = 0.75
FREQUENT_CITY_COUNT = 45
DELIVERY, TAKEOUT, IS_OPEN = ("attributes_RestaurantsDelivery", "attributes_RestaurantsTakeOut",
                              "is_open")
UNUSED = ("address", "latitude", "longitude", "name", "postal_code", "state")


def with_leisure_flag(df: DataFrame, categories: str = "categories", trim: bool = True) -> DataFrame:
    """Sanitised names plus ``isLeisure`` from the first five categories."""
    df = sanitize_columns(df)
    cats = list(split_columns(categories, ",", 5, "_c", trim).values())
    return df.withColumn("isLeisure", _flag(isin_any(cats, LEISURE_CATEGORIES))).drop(categories)


def candidate_rows(df: DataFrame) -> DataFrame:
    """Open businesses without delivery and without take-out."""
    return (df.where(not_true(DELIVERY) & not_true(TAKEOUT) & flag_set(IS_OPEN))
            .drop(DELIVERY, TAKEOUT, IS_OPEN))


# The columns that the encoders consume.
ENCODED = (*TOKEN_GROUPS, *CONTAINS_FLAGS, *TRUE_FLAGS, *(f"hours_{d}" for d in DAYS))


def encoded_columns() -> dict:
    """All row-wise encoder outputs as ``{name: Column}`` (the city is encoded apart)."""
    parts = [one_hot_columns(c, groups) for c, groups in TOKEN_GROUPS.items()]
    parts += [{out: _flag(F.coalesce(F.col(c).contains("True"), F.lit(False)))}
              for c, out in CONTAINS_FLAGS.items()]
    parts += [true_flag_columns(c, out, "True", null_out)
              for c, (out, null_out) in TRUE_FLAGS.items()]
    sat, sun = F.col("hours_Saturday"), F.col("hours_Sunday")
    parts.append({"open_weekends": _flag(sat.isNotNull() | sun.isNotNull())})
    parts += [sentinel_class_columns(f"hours_{day}", day, ALL_DAY) for day in DAYS]
    cols = {k: c for part in parts for k, c in part.items()}
    if len(cols) < sum(map(len, parts)):
        raise ValueError("two encoders write the same column")
    return cols


@dataclass(frozen=True)
class EntityFeaturesModel:
    null_filter: NullFilterSpec
    city: FrequentOneHotSpec | FrequentCategorySpec
    trim: bool = True

    def transform(self, raw: DataFrame) -> DataFrame:
        df = self.null_filter.apply(with_leisure_flag(raw, trim=self.trim))
        have = set(df.columns)
        missing = [c for c in (*ENCODED, DELIVERY, TAKEOUT, IS_OPEN, self.city.column)
                   if c not in have]
        if missing:
            raise ValueError(f"entity encoders need columns the table lacks (removed by the "
                             f"null filter or absent): {missing}")
        out = (candidate_rows(df).withColumns(encoded_columns())
               .drop(*ENCODED, *(c for c in UNUSED if c in have)))
        return self.city.apply(out)


def fit_entity_features(raw: DataFrame, trim: bool = True,
                        null_share: float = NULL_SHARE_LIMIT,
                        min_city_count: int = FREQUENT_CITY_COUNT,
                        key: str = "business_id", cities=None,
                        city_table: str | None = None) -> EntityFeaturesModel:
    """The null profile (a bounded action: one row per column) and the city encoding.

    By default the frequent cities of the candidate rows are written to ``city_table`` (or a
    fresh path of the shared scratch folder) and joined back as the column ``city_group``
    (a frequent city or ``others``): the same columns at every data size. ``cities`` declares
    a vocabulary instead and gives one 0/1 column per city plus ``city_others``.
    """
    flagged = with_leisure_flag(raw, trim=trim)
    nf = fit_null_filter(flagged, null_share)
    if cities is not None:
        city = frequent_one_hot_spec("city", cities, "city_", "city_others")
    else:
        table = city_table or scratch_path(raw.sparkSession, "frequent-city")
        city = fit_frequent_category(candidate_rows(nf.apply(flagged)), "city", min_city_count,
                                     table, count_of=key, out="city_group")
    return EntityFeaturesModel(nf, city, trim)


def entity_features(raw: DataFrame, **kw) -> DataFrame:
    """Fit and apply in one call."""
    return fit_entity_features(raw, **kw).transform(raw)
