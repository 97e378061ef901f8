"""strata: raw, re-dumped JSON records into trusted tables and metrics, as DataFrame functions."""
