"""What the tests share beside fixtures."""

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = (
    "incident_id string, timestamp timestamp, incident_type string, severity string, zone string, "
    "response_time double"
)


def rows_of(df, *columns):
    """Rows as plain tuples in a fixed order, nulls first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
