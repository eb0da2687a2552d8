"""Column-level functions (strings, numbers, dates, nested values)."""

from marketlake.functions.dates import (closest_weekday, date_series, day_bounds, iso_saturday, iso_week,  # noqa: F401
                                        local_date, long_date, parse_two_formats, to_utc, week_start, within_age)
from marketlake.functions.nested import (contains_all, first_of, flatten_lists, json_nonempty, json_path,  # noqa: F401
                                         last_matches, last_where, last_with, sum_ints)
from marketlake.functions.numeric import (allocate, bounded_int, clean_money, clean_number, int_ratio,  # noqa: F401
                                          money, percent_ratio, price_fallback, ratio)
from marketlake.functions.text import (bracketed_id, campaign_key, canonical_targeting, currency_code,  # noqa: F401
                                       digits_only, last_chars, match_type, norm_key, null_if_token,
                                       placement_label, product_code, repair_search_query, strip_non_word)
