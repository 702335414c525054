"""Data products, each a function from DataFrames to a DataFrame."""

from .attributes import person_attributes
from .build import build_all, build_fact, write_fact
from .enrich import card_dimension, enrich_transactions, terminal_dimension
from .lookalike import (categorical_score, gaussian_weights, lookalike_scores, numeric_score,
                        population_features, score_population)
from .rfm import rfm_features, rfm_segments
from .rules import RULES, check_products, failing, write_checked
from .rollups import household_rollup, media_long, media_rollup, person_rollup
from .seeds import SeedChoice, choose_seed, preset, rfm_reference, seed_grid, seed_ids, tune_seed
from .summary import daily_summary, daily_summary_stream
from .validation import (Audience, add_rates, audiences_from, reach_curve, run_delta,
                         validate_audiences)
