from aerostrata.functions.classify import aqi_category, aqi_risk_score, register_sql_functions
from aerostrata.functions.identity import document_id
from aerostrata.functions.times import day_key, hour_timestamp, parse_event_time

__all__ = [
    "aqi_category",
    "aqi_risk_score",
    "day_key",
    "document_id",
    "hour_timestamp",
    "parse_event_time",
    "register_sql_functions",
]
