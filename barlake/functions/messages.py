"""SCL-14: issue texts, in the fixed wording of the check results, as SQL over the counter columns."""

from __future__ import annotations

from barlake.schema import DAILY, TIMEFRAME, VALUES


def missing_values() -> str:
    listed = ", ', ', ".join(f"'\\'{c.capitalize()}\\': ', n_missing_{c}" for c in VALUES)
    return f"concat('Missing values: {{', {listed}, '}}')"


def duplicate_timestamps() -> str:
    return "concat('Found ', n_duplicates, ' duplicate timestamps')"


def price_inconsistency() -> str:
    """Parts with a zero count are NULL, and concat_ws skips them."""
    parts = [
        ("High < Low: ", "n_high_low"),
        ("Close outside High/Low range: ", "n_close_out"),
        ("Open outside High/Low range: ", "n_open_out"),
    ]
    listed = ", ".join(f"CASE WHEN {n} > 0 THEN concat('{label}', {n}, ' rows') END" for label, n in parts)
    return f"concat_ws('; ', {listed})"


def volume_anomaly() -> str:
    return "concat('Zero or negative volume: ', n_no_volume, ' rows')"


def outliers() -> str:
    return "concat('Price outliers (|z| > 3): ', n_outliers, ' occurrences')"


def time_gaps() -> str:
    tail = f"CASE WHEN {TIMEFRAME} = '{DAILY}' THEN ' gaps > 3 days' ELSE ' gaps' END"
    return f"concat('Large time gaps detected: ', n_gaps, {tail})"
