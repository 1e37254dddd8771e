"""Fixed schemas of the ad tables. No schema inference anywhere."""

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DateType()
MONEY = T.DecimalType(10, 2)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw report record: one row per ad block.
RAW_AD = _struct(("url", S), ("fields", T.MapType(S, S)), ("block", S),
                 ("source_file", S), ("run_date", D))

# Formatted ad table: 7 strings that still carry their label prefix (D3).
FORMATTED_COLUMNS = ["URL", "Room_count", "Size_sq_m", "Floor", "Street", "Price", "Pub_date"]
FORMATTED = _struct(*[(c, S) for c in FORMATTED_COLUMNS])

# Cleaned ad table as the reference's CSV has it.
CLEANED_CSV = _struct(("URL", S), ("Room_count", S), ("Floor", S), ("Street", S),
                      ("Pub_date", S), ("Size_sqm", S), ("Price_in_eur", S),
                      ("SQ_meter_price", S))

# Typed, cleaned ads: the table every analysis starts from.
CLEAN_ADS = _struct(("url", S), ("url_hash", S), ("city", S), ("room_label", S),
                    ("room_count", I), ("apt_floor", I), ("house_floors", I),
                    ("has_lift", T.BooleanType()), ("street", S), ("pub_date", D),
                    ("size_sqm", MONEY), ("price_eur", L), ("sqm_price_eur", MONEY),
                    ("run_date", D))

# Currently open ads (D5) and removal history.
LISTED_ADS = _struct(("url_hash", S), ("room_count", I), ("house_floors", I),
                     ("apt_floor", I), ("price", L), ("sqm", L), ("sqm_price", L),
                     ("apt_address", S), ("list_date", D), ("days_listed", I),
                     ("view_count", I))
REMOVED_ADS = _struct(("url_hash", S), ("room_count", I), ("house_floors", I),
                      ("apt_floor", I), ("price", L), ("sqm", L), ("sqm_price", L),
                      ("apt_address", S), ("listed_date", D), ("removed_date", D),
                      ("days_listed", I), ("view_count", I))

RUN_METRICS = _struct(("run_date", D), ("scraped", L), ("in_db", L), ("unchanged", L),
                      ("new_ads", L), ("removed", L), ("active_total", L),
                      ("removed_total", L), ("removed_under_cap", L))

QUARANTINE = _struct(("source_file", S), ("block", S), ("reason", S), ("run_date", D))
