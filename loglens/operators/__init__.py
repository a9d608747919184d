"""DataFrame -> DataFrame operators; each works on batch and streaming inputs
unless its docstring says otherwise (sorts, ranks and limits are batch-only,
as in Structured Streaming; streams apply them inside ``foreachBatch``)."""

from loglens.operators.words import (
    tokenize, word_count, word_count_sorted, line_lengths, longest_line,
)
from loglens.operators.filters import isin_filter, member_filter, regex_filter
from loglens.operators.aggregates import (
    total_sum, observe_sum, observed_total, concat_ordered, concat_offsets, concat_pieces,
)
from loglens.operators.scan import running_totals
from loglens.operators.udfs import (
    check_serializable, predicate_udf, regex_predicate_udf,
    series_predicate_udf, filter_with_partition_resource, user_aggregate, concat_udaf, span_udaf,
)
from loglens.operators.access_log import parse_access_log, access_log_rejects
from loglens.operators.windows import (
    hits_by_ip, hits_by_window, window_aggregate, project_windows, min_hits, leaderboard,
)
from loglens.operators.snapshot import newest_window, snapshot_json
from loglens.operators.keywords import (
    agent_keywords, keyword_freq, distinct_keywords, top_keywords, agents_of,
)
from loglens.operators.joins import hot_split_join
from loglens.operators.counts import tumbling_counts, count_message

__all__ = [name for name in dir() if not name.startswith("_")]
