from .bitmaps import bitmap_counts, cardinalities_by, distinct_bitmaps, merge_bitmaps
from .certificate import certificate
from .clean import clean_interactions, profile
from .colocated import bucketed, predict_bucketed, score_bucketed
from .explore import behavior_counts, cardinalities, distinct_ids, plays, top_items, top_n, top_users, totals
from .indexing import Dictionary, build_dictionaries, build_dictionary, decode, encode, lookup_index
from .joins import BROADCAST_MAX_ROWS, sized_broadcast
from .metrics import (
    actual_items,
    hits_per_user,
    precision_random_expectation,
    random_recs,
    ranking_metrics,
    ranking_per_user,
    rec_items,
    rec_positions,
    rmse,
    running_precision,
    score_report,
)
from .model import BASELINE, FIRST_MODEL, ALSConfig, fit_als, id_load, predict, recommend_for_items, recommend_for_users, score_pairs
from .postings import posting_lists
from .present import (
    first_rows,
    flatten_item_recs,
    flatten_user_recs,
    readable_item_recs,
    readable_user_recs,
    recommend_for_user_labels,
    recommend_users_for_game_names,
    recs_for_user,
    recs_for_user_label,
    users_for_game,
)
from .ratings import Split, build_ratings, cold_start_coverage, hash_split, index_interactions, random_split, split_counts, with_split
from .topk import norm_index, pack, top_k_by_dot, top_k_visits, two_way_top_k
from .tuning import best_config, grid_search, leaderboard, param_grid, rank_marginals, runs_for, tradeoff_points
