"""DataFrame operators: joins, aggregates, statistics, ranking, sets, quality, incremental."""

from .aggregates import (count_distinct_ids, distinct_list, distinct_rows, ids_with_min_rows,
                         month_bounds, ref_date, summarise, tag_count_maps, tags_long,
                         window_diversity, windowed_aggs)
from .incremental import (DuplicateKeys, merge_partitions, replace_slice, newer_than, require_unique,
                          since_high_water, upsert)
from .joins import (active_ids, label_membership, latest_version, left_enrich, membership,
                    recent_ids)
from .materialise import materialise, scratch_path, shared_dir, stored_once
from .months import MONTH, month_text, prune_months, with_month
from .quality import Check, expr_true, not_null, report, unique, unique_combo
from .sets import cohort_bitmaps, cohort_except, cohort_intersect, cohort_overlap, cohort_union
from .skew import GROUP_ROWS, large_groups
from .stats import category_importance, category_shares, numeric_profile
from .topn import cluster, interleave, score_cut, top_n, with_rank
