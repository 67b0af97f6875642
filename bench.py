"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kelpfit.plans import load  # noqa: E402
from kelpfit.session import local_session  # noqa: E402

HEADLINE = (
    "linreg_fit linreg_weighted linreg_metrics linreg_residual_hist split_exact split_composite_key "
    "permute_rows mini_batches scale_standard_matrix scale_robust scale_vectors dist_euclidean dist_canberra "
    "weighted_median kmeans_init_farthest kmeans_iter3 kmeans_predict kmeans_converged knn_topk knn_vote "
    "knn_weighted_vote knn_mean knn_wmedian tree_yesno_nodes tree_mixed_nodes tree_many_values regtree_nodes "
    "regtree_orders_nodes neuron_train neuron_minibatch mlp_forward search_random search_descent"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries, _ = load()
    names = sys.argv[1:] or HEADLINE
    # one warm-up, so that the first query does not pay for starting the workers
    queries["mlp_forward"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
