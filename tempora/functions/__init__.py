"""Row-local column logic: projections and predicates (B), scalar
functions (C).  No shuffles; usable on streaming DataFrames as well."""
