from rivermart.functions.money import cents, from_cents
from rivermart.functions.people import age_group, age_years
from rivermart.functions.records import json_fields, parse_once, parse_records, typed_field
from rivermart.functions.times import date_part, hour_part

__all__ = ["age_group", "age_years", "cents", "date_part", "from_cents", "hour_part",
           "json_fields", "parse_once", "parse_records", "typed_field"]
