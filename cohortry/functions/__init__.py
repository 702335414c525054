"""Reusable column expressions and the fixed code tables they are driven by."""

from . import codes
from .maps import (dynamic_map, flag_map, interest_map, list_membership_map, map_text,
                   map_without_nulls, present_map, tag_array)
from .scalars import (age_code, argmin_label, bucket, decode, flag, greatest_or_null, in_range,
                      income_amount, income_code, int_or_zero, is_filled, keyword_match, likely,
                      month_filter, normalise, parse_age, parse_yyyymmdd, ratio, split_list,
                      tag_if_present, to_int)
