from tierline.functions.columns import (
    all_set,
    date_parts,
    map_codes,
    normal_name,
    same_key,
    to_event_time,
    whole_number,
)

__all__ = ["all_set", "date_parts", "map_codes", "normal_name", "same_key", "to_event_time", "whole_number"]
