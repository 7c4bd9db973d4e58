"""Name -> query builder ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from likeness.plans import pairs as pr
from likeness.plans import recommend as rc
from likeness.plans import similarity as sim

QUERIES = {
    # item sets
    "grouped_items": pr.q_grouped_items,
    "item_lists": pr.q_item_lists,
    "grouped_audit": pr.q_grouped_audit,
    # similar entities
    "minhash_signatures": sim.q_minhash_signatures,
    "signature_groups": sim.q_signature_groups,
    "lsh_candidates": sim.q_lsh_candidates,
    "similar_pairs": sim.q_similar_pairs,
    "pairs_per_threshold": sim.q_pairs_per_threshold,
    "top_pairs_by_threshold": sim.q_top_pairs_by_threshold,
    "csv_roundtrip": pr.q_csv_roundtrip,
    "user_signatures": sim.q_user_signatures,
    "similar_users": sim.q_similar_users,
    # ratings file
    "ratings_from_csv": pr.q_ratings_from_csv,
    "ratings_csv_rejects": pr.q_ratings_csv_rejects,
    # pair checks and the random control group
    "pair_validation": pr.q_pair_validation,
    "pair_common_ratings": pr.q_pair_common_ratings,
    "pair_correlation": pr.q_pair_correlation,
    "pair_noted_ratings": pr.q_pair_noted_ratings,
    "avg_pair_correlation": pr.q_avg_pair_correlation,
    "eligible_users": pr.q_eligible_users,
    "random_pairs": pr.q_random_pairs,
    "random_pair_baseline": pr.q_random_pair_baseline,
    # split
    "split_assignment": rc.q_split_assignment,
    "split_summary": rc.q_split_summary,
    "enriched_split": rc.q_enriched_split,
    "tagged_split": rc.q_tagged_split,
    # popularity baseline and ranking metrics
    "item_stats": rc.q_item_stats,
    "popularity_topk": rc.q_popularity_topk,
    "beta_sweep": rc.q_beta_sweep,
    "best_beta_test": rc.q_best_beta_test,
    "ndcg_by_user": rc.q_ndcg_by_user,
    "ndcg_mean": rc.q_ndcg_mean,
    # personal lists, sinks and results
    "personal_lists": rc.q_personal_lists,
    "personal_ndcg": rc.q_personal_ndcg,
    "split_roundtrip": rc.q_split_roundtrip,
    "metric_results": rc.q_metric_results,
    # backfill and ALS
    "cold_items": rc.q_cold_items,
    "backfill_rows": rc.q_backfill_rows,
    "train_with_backfill": rc.q_train_with_backfill,
    "als_input": rc.q_als_input,
    "implicit_confidence": rc.q_implicit_confidence,
    "implicit_confidence_avg": rc.q_implicit_confidence_avg,
    "als_explicit": rc.q_als_explicit,
    "als_implicit": rc.q_als_implicit,
    "als_grid": rc.q_als_grid,
}
