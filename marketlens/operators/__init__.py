"""DataFrame operators: quality, latest observation, merge, reports, segments, prediction."""
