from geoincident.operators.coords import (clean_coordinates, parse_coordinates, tag_coordinates,
                                          tag_parsed_coordinates)
from geoincident.operators.distances import with_destination, with_geodesic_km, with_great_circle_km
from geoincident.operators.extremes import extreme_values, filter_extreme_groups
from geoincident.operators.geodesic import ELLIPSOIDS, geodesic_km, vincenty_km
from geoincident.operators.joins import (STRATEGIES, checked_broadcast, join_strategy_used,
                                         join_with_strategy, plan_text)
from geoincident.operators.path import path_length
from geoincident.operators.ranking import top_k_per_group
from geoincident.operators.spatial import nearest_facility, within_distance_join

__all__ = ["ELLIPSOIDS", "STRATEGIES", "checked_broadcast", "clean_coordinates",
           "extreme_values", "filter_extreme_groups", "geodesic_km", "join_strategy_used",
           "join_with_strategy", "nearest_facility", "parse_coordinates", "path_length",
           "plan_text", "tag_coordinates", "tag_parsed_coordinates", "top_k_per_group", "vincenty_km", "with_destination", "with_geodesic_km", "with_great_circle_km",
           "within_distance_join"]
