"""A small portal with the awkward cases, for tests."""

import datetime as dt

from tallyport.operators.clean import PortalTables

LOG = (
    "user_id bigint, user_name string, institution_id int, group_name string, source_name string, "
    "request_type int, n_codes int, requested_at timestamp_ntz"
)


def at(text):
    return dt.datetime.fromisoformat(text)


def tables(spark, log, institution=None, account=None, membership=None, status=None):
    institution = institution or [(1, "Alpha "), (2, "beta"), (3, None)]
    return PortalTables(
        spark.createDataFrame(log, LOG),
        spark.createDataFrame(institution, "institution_id int, institution_name string"),
        spark.createDataFrame(account or [(10, 0, 0)], "user_id bigint, created_s bigint, access_s bigint"),
        spark.createDataFrame(membership or [(10, 1)], "user_id bigint, institution_id int"),
        spark.createDataFrame(status or [(10, "PhD")], "user_id bigint, status string"),
    )


def line(user=10, name="u10", institution=1, group="g", source="esg_x", kind=1, codes=5, when="2021-03-04 10:00:00"):
    return (user, name, institution, group, source, kind, codes, at(when) if when else None)
