"""Contracts: the columns and types that a model must come out with."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Names, order and types of the models' columns.
STAGING = {
    "unique_key": "string",
    "created_date": "timestamp",
    "closed_date": "timestamp",
    "due_date": "timestamp",
    "resolution_action_updated_date": "timestamp",
    "updated_at": "timestamp",
    "agency": "string",
    "agency_name": "string",
    "complaint_type": "string",
    "descriptor": "string",
    "descriptor_2": "string",
    "location_type": "string",
    "incident_zip": "string",
    "incident_address": "string",
    "street_name": "string",
    "cross_street_1": "string",
    "cross_street_2": "string",
    "intersection_street_1": "string",
    "intersection_street_2": "string",
    "address_type": "string",
    "city": "string",
    "landmark": "string",
    "facility_type": "string",
    "status": "string",
    "resolution_description": "string",
    "community_board": "string",
    "council_district": "string",
    "police_precinct": "string",
    "bbl": "string",
    "borough": "string",
    "x_coordinate_state_plane": "double",
    "y_coordinate_state_plane": "double",
    "open_data_channel_type": "string",
    "park_facility_name": "string",
    "park_borough": "string",
    "vehicle_type": "string",
    "taxi_company_borough": "string",
    "taxi_pick_up_location": "string",
    "bridge_highway_name": "string",
    "bridge_highway_direction": "string",
    "road_ramp": "string",
    "bridge_highway_segment": "string",
    "latitude": "double",
    "longitude": "double",
    "has_valid_coordinates": "boolean",
    "computed_region_community_districts": "double",
    "computed_region_borough_boundaries": "double",
    "computed_region_police_precincts": "double",
    "computed_region_city_council_districts": "double",
}
RESOLUTION = {
    "unique_key": "string",
    "created_date": "timestamp",
    "closed_date": "timestamp",
    "is_closed": "boolean",
    "is_settled": "boolean",
    "is_censored": "boolean",
    "is_undated_closure": "boolean",
    "resolution_hours": "bigint",
}
GEOGRAPHY = {
    "unique_key": "string",
    "borough": "string",
    "community_board": "string",
    "incident_zip": "string",
    "latitude": "double",
    "longitude": "double",
    "has_valid_coordinates": "boolean",
}
AGENCY = {
    "agency_key": "bigint",
    "agency": "string",
    "agency_name": "string",
}
COMPLAINT_TYPE = {
    "complaint_type_key": "bigint",
    "complaint_type": "string",
    "descriptor": "string",
}
LOCATION = {
    "location_key": "bigint",
    "community_board": "string",
    "borough": "string",
}
DATE = {
    "date_key": "date",
    "calendar_date": "date",
    "year": "bigint",
    "quarter": "bigint",
    "month": "bigint",
    "month_name": "string",
    "day_of_month": "bigint",
    "day_of_week": "bigint",
    "day_name": "string",
    "is_weekend": "boolean",
    "season": "string",
}
FACT = {
    "unique_key": "string",
    "agency_key": "bigint",
    "complaint_type_key": "bigint",
    "location_key": "bigint",
    "date_key": "date",
    "created_date": "timestamp",
    "closed_date": "timestamp",
    "updated_at": "timestamp",
    "resolution_hours": "bigint",
    "is_closed": "boolean",
    "is_censored": "boolean",
    "is_settled": "boolean",
    "is_undated_closure": "boolean",
    "has_valid_coordinates": "boolean",
    "latitude": "double",
    "longitude": "double",
    "incident_zip": "string",
    "status": "string",
    "borough": "string",
}

ALL = {
    "stg_service_requests": STAGING, "int_request_resolution": RESOLUTION, "int_request_geography": GEOGRAPHY, "dim_agency": AGENCY,
    "dim_complaint_type": COMPLAINT_TYPE, "dim_location": LOCATION, "dim_date": DATE, "fct_service_requests": FACT,
}


class ContractError(ValueError):
    pass


def enforce(df: DataFrame, name: str) -> DataFrame:
    """The same table, if its columns are what the contract of the model says."""
    found, wanted = dict(df.dtypes), ALL[name]
    if list(found.items()) != list(wanted.items()):
        wrong = {k: (found.get(k), wanted.get(k)) for k in {*found, *wanted} if found.get(k) != wanted.get(k)}
        raise ContractError(f"{name}: {wrong or 'columns are in another order'}")
    return df
