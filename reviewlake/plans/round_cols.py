"""Double columns per oracle query (generated by tools/gen_round_cols.py)."""

ROUND_COLS = {
    'abs_importance': ['importance', 'abs_importance'],
    'app_sentiment_share': ['positive_pct', 'negative_pct'],
    'auc': ['area_under_roc'],
    'class_weights': ['weight'],
    'compare_thresholds': ['accuracy', 'f1_score', 'weighted_precision', 'weighted_recall', 'area_under_roc'],
    'confusion_metrics': ['precision', 'recall', 'specificity', 'accuracy', 'f1', 'false_positive_rate', 'false_negative_rate'],
    'confusion_percent': ['tn_pct', 'fp_pct', 'fn_pct', 'tp_pct'],
    'display_names': ['score'],
    'evaluate': ['value'],
    'export_predictions': ['probability_negative', 'probability_positive'],
    'feature_importance': ['importance'],
    'hashing_tf': ['tf'],
    'idf': ['idf'],
    'label_index': ['label'],
    'length_gap': ['negative_avg_length', 'positive_avg_length', 'length_gap'],
    'length_histogram': ['bin_start', 'bin_end'],
    'length_quantiles': ['p25', 'p50', 'p75'],
    'length_stats': ['mean_length', 'std_length', 'median_length', 'p75_length'],
    'length_votes_trend': ['slope', 'intercept', 'x', 'y_fit'],
    'load_model': ['label', 'prediction', 'probability'],
    'lr_minimum': ['weight_0', 'weight_1'],
    'lr_numeric_scores': ['label', 'length', 'words', 'votes', 'app_reviews', 'app_positive'],
    'lr_scores': ['label'],
    'melt_metrics': ['score'],
    'metric_winners': ['best_score'],
    'nb_importance': ['importance'],
    'nb_posterior': ['label', 'prediction', 'probability'],
    'nb_theta': ['theta'],
    'numeric_features': ['app_positive_ratio'],
    'probability_columns': ['probability_negative', 'probability_positive'],
    'profile': ['value'],
    'rank_models': ['accuracy', 'f1_score', 'weighted_precision', 'weighted_recall', 'area_under_roc'],
    'roc_points': ['score', 'tpr', 'fpr'],
    'run_metrics': ['value'],
    'save_model': ['label', 'prediction', 'probability'],
    'score': ['label', 'prediction', 'probability'],
    'score_histogram': ['bin_start'],
    'sentiment_share': ['percent'],
    'signed_features': ['importance'],
    'stored_length_stats': ['mean_length', 'std_length', 'median_length', 'p75_length'],
    'text_length_summary': ['avg_review_text_length'],
    'text_pipeline': ['label', 'prediction', 'probability'],
    'tfidf': ['weight'],
    'threshold_points': ['target', 'score', 'fpr', 'tpr'],
    'top_apps': ['avg_review_votes'],
    'top_apps_by_votes': ['avg_review_votes'],
    'top_apps_by_votes_of_20': ['avg_review_votes'],
    'top_apps_n': ['avg_review_votes'],
    'top_features': ['importance'],
    'top_features_n': ['importance', 'abs_importance'],
    'train_dt': ['label', 'prediction', 'probability'],
    'train_gbt': ['label'],
    'train_lr': ['weight_0', 'weight_1'],
    'train_lr_numeric': ['weight_0', 'weight_1'],
    'train_lr_weighted': ['weight_0', 'weight_1'],
    'train_nb': ['label', 'prediction', 'probability'],
    'train_rf': ['label'],
    'walk_dt': ['label', 'prediction', 'probability'],
    'youden_threshold': ['score', 'tpr', 'fpr', 'youden_j'],
}
