from geoincident.sources.files import (
    FACILITY_SCHEMA, GEOCODE_SCHEMA, INCIDENT_SCHEMA, INCOME_SCHEMA, profile,
    read_facilities, read_geocodes, read_income, read_incidents, read_table,
    union_aligned)

__all__ = ["FACILITY_SCHEMA", "GEOCODE_SCHEMA", "INCIDENT_SCHEMA", "INCOME_SCHEMA",
           "profile", "read_facilities", "read_geocodes", "read_income",
           "read_incidents", "read_table", "union_aligned"]
