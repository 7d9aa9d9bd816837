"""DataFrame-to-DataFrame operators: mapping, staging, merging, checking, comparing."""
