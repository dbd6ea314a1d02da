"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from reelhouse.functions.casts import (epoch_to_ts, id_from_text, safe_cast,
                                       to_day)
from reelhouse.functions.strings import (external_id, null_if_token, parse_list_text,
                                         poster_url, split_list, trimmed_list)
from reelhouse.functions.arrays import (field_of_each, first_k, first_match,
                                        tag_set_count, tag_set_flag)

__all__ = [
    "epoch_to_ts", "id_from_text", "safe_cast", "to_day",
    "external_id", "null_if_token", "parse_list_text", "poster_url", "split_list", "trimmed_list",
    "field_of_each", "first_k", "first_match", "tag_set_count", "tag_set_flag",
]
