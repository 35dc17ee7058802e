from plumeline.functions.geo import cell_index, haversine_m, lat_reach_deg, lon_reach_deg
from plumeline.functions.location import geocode, locate, normalized_location, parse_location, with_location
from plumeline.functions.names import month_from_name, orbit_from_name
from plumeline.functions.numeric import (grid_snap, is_fractional, lenient_double, lenient_int,
                                         nan_to_null, round_n)

__all__ = [
    "cell_index", "haversine_m", "lat_reach_deg", "lon_reach_deg",
    "geocode", "locate", "normalized_location", "parse_location", "with_location",
    "month_from_name", "orbit_from_name",
    "grid_snap", "is_fractional", "lenient_double", "lenient_int", "nan_to_null", "round_n",
]
