from segrec.operators.clusters import (  # noqa: F401
    assign_by_thresholds,
    assign_clusters,
    assign_nearest,
    describe_clusters,
    fit_clusters,
    fit_sweep,
    kmeans_invariants,
    training_cost,
)
from segrec.operators.evaluate import (  # noqa: F401
    evaluate,
    global_metrics,
    per_user_metrics,
    relevant_counts,
    relevant_items,
)
from segrec.operators.features import assemble, clusterable, scale_features, unpack_vector, user_features  # noqa: F401
from segrec.operators.prepare import (  # noqa: F401
    explode_genres,
    hash_split,
    profile,
    random_split,
    rating_distribution,
    split_profile,
)
from segrec.operators.ranking import rank_within_groups, top_n_per_group  # noqa: F401
from segrec.operators.recommend import (  # noqa: F401
    candidate_counts,
    rank_items,
    recommend,
    sample_recommendations,
    seen_items,
)
from segrec.operators.scoring import (  # noqa: F401
    cluster_genres,
    cluster_item_scores,
    cluster_stats,
    clusters_of,
    pairs_of,
    relevant_of,
    split_pairs,
    top_genres,
    with_clusters,
)
from segrec.operators.serving import (  # noqa: F401
    count_documents,
    document_stats,
    flatten_documents,
    lookup,
    missing,
    pack_documents,
    page,
    page_envelope,
    preview_documents,
)
from segrec.operators.sweep import best_k, metrics_summary, union_metrics  # noqa: F401
