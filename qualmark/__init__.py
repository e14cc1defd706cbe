"""qualmark: a PySpark data-quality and column-anomaly engine.

Every operator is a function from DataFrames to DataFrames. Series are
identified by key columns of the data (default ``gamecode, column``), so
one job handles many columns and many sources at once.

Sub-packages:

* ``functions`` - column expressions (time slots, byte codes, safe maths)
* ``operators`` - counts, control limits, rules, sampling, value scores
* ``sources``   - readers and writers (delimited, JSON lines, JDBC, dated)
* ``plans``     - end-to-end compositions (daily null / frequency checks,
  train -> score -> summarise) and the registered test-data queries
* ``streaming`` - the ten-minute null count on a stream
"""

__version__ = "0.1.0"

DEFAULT_KEYS = ("gamecode", "column")

# Public operators (imported after DEFAULT_KEYS, which they use).
from .operators.counts import (day_totals, dedupe_by_max, freq_count, null_count,  # noqa: E402
                               score_metrics, score_summary)
from .operators.density import fit_kde, latest_models, score_day, score_kde  # noqa: E402
from .operators.latent import fit_latent, latent_scores  # noqa: E402
from .operators.limits import (freq_alerts, freq_memo, freq_rates, freq_threshold, null_alerts,  # noqa: E402
                               null_memo, null_threshold)
from .operators.rules import (date_range, name_columns, not_null, rule_length, rule_min_max,  # noqa: E402
                              rule_passthrough, split_value_md5, tag_series)
from .operators.sampling import (copy_table, distinct_values, distinct_values_md5, extract,  # noqa: E402
                                 page_by_row_number, sample_per_series, sample_rows, sample_rows_md5)
from .operators.strings import (encode_positions, fit_string_profile, profile_mode, rank_anomalies,  # noqa: E402
                                score_strings)
