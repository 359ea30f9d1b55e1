"""Composite jobs: the trip questions, the search-log profile, file conversions,
and the catalog of registered queries with their oracle SQL."""
