from geoincident.functions.codes import DESCENT_CODES, decode
from geoincident.functions.daypart import hhmm_of, part_of_day
from geoincident.functions.geo import (COMPASS_POINTS, EARTH_RADIUS_KM, compass_point,
                                        destination, great_circle_km, initial_bearing,
                                        wrap_longitude)
from geoincident.functions.money import parse_money
from geoincident.functions.timeops import text_to_date
from geoincident.functions.units import convert_angle, convert_length

__all__ = ["COMPASS_POINTS", "DESCENT_CODES", "EARTH_RADIUS_KM", "compass_point",
           "convert_angle", "convert_length", "decode", "destination", "great_circle_km",
           "hhmm_of", "initial_bearing", "parse_money", "part_of_day", "text_to_date",
           "wrap_longitude"]
