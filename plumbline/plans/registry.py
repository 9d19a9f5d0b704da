"""Queries of the core by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans import analytics, bias, collecting, evalset, ranking


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every core query; each takes a session and a folder of tables."""
    return {
        "q01_daily_users": analytics.daily_users,
        "q02_model_text_lengths": analytics.model_text_lengths,
        "q03_session_funnel": analytics.session_funnel,
        "q04_golden_check": analytics.golden_check,
        "q05_target_by_category": analytics.target_by_category,
        "q06_target_by_query": analytics.target_by_query,
        "q07_winrate_matrix": analytics.winrate_matrix,
        "q08_ipw_winrates": analytics.ipw_winrates,
        "q07_matrix_report": analytics.matrix_report,
        "q08_ipw_report": analytics.ipw_report,
        "q09_bias_battery": bias.bias_battery,
        "q09a_session_filters": bias.session_filter_counts,
        "q10_answer_times": analytics.answer_time_distribution,
        "q11_user_quality": analytics.user_quality,
        "q12a_user_behaviour": analytics.user_behaviour,
        "q12b_golden_questions": analytics.golden_questions,
        "q12c_golden_details": analytics.golden_details,
        "b02_single_games": ranking.single_games,
        "b05_bt_report": ranking.bt_report,
        "b08_game_balance": ranking.game_balance,
        "b08_balanced_ranking": ranking.balanced_ranking,
        "b09_winrate_differences": ranking.winrate_differences,
        "b09_difference_summary": ranking.difference_summary,
        "b09_top_differences": ranking.top_differences,
        "b09_difference_wide": ranking.difference_wide,
        "b10_matrix_labels": ranking.matrix_labels,
        "b10_matrix_wide": ranking.matrix_wide,
        "b11_dimension_shares": ranking.dimension_shares,
        "b12_rank_by_dimension": ranking.rank_by_dimension,
        "b12_strength_by_rank": ranking.strength_by_rank,
        "b13_bootstrap": ranking.bootstrap,
        "b14_user_verdicts": analytics.user_verdicts,
        "g01_game_sets": evalset.game_sets,
        "g02_exact_dedup": evalset.deduplicated,
        "g02_folded_dedup": evalset.deduplicated_folded,
        "g03_invalid_queries": evalset.invalid_queries,
        "g04_prepared_queries": evalset.prepared_queries,
        "g06_neighbours": evalset.vector_neighbours,
        "g06_edges": evalset.similar_edges,
        "g07_confirmed_edges": evalset.confirmed_edges,
        "g08_duplicate_groups": evalset.duplicate_groups,
        "g10_marked_duplicates": evalset.marked_duplicates,
        "g11_category_matches": evalset.category_matches,
        "g11_excluded": evalset.excluded_queries,
        "g11_subcategories": evalset.subcategories,
        "g12_scores": evalset.scores,
        "g13_quotas": evalset.quotas,
        "g13_game_quotas": evalset.game_quotas,
        "g14_slice_coverage": evalset.slice_coverage,
        "g16_selection": evalset.selection,
        "g17_sliced_selection": evalset.sliced_selection,
        "g18_selection_details": evalset.selection_details,
        "g19_rejected": evalset.rejected_queries,
        "g19_replaced_selection": evalset.replaced_selection,
        "g21_run_summary": evalset.run_summary,
        "s02_month_answers": collecting.month_answers,
        "c01_collection_run": collecting.collection_run,
        "c04_cleaned_answers": collecting.cleaned_answers,
        "c04_answer_metadata": collecting.answer_metadata,
        "c07_wide_answers": collecting.wide_answers,
        "c09_latest_sets": collecting.latest_sets,
        "c10_named_models": collecting.named_models,
        "c11_answer_statistics": collecting.answer_statistics,
        "c13_golden_items": collecting.golden_items,
        "c14_games": collecting.games,
        "f11_answer_truths": collecting.answer_truths,
        "f13_text_measures": collecting.text_measures,
    }
