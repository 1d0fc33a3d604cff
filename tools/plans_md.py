"""Write PLANS.md: per-query plan summary and formatted plans of key queries.

Usage: python tools/plans_md.py  (reads /root/testdata/sf0.01)
"""

import sys, io, contextlib
import os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tessera.plans import catalog, catalog_more
from tessera.session import local_session
from tools.plan_report import summarise
spark = local_session(8)
sf = "/root/testdata/sf0.01"
rows = []
for name, fn in {**catalog.QUERIES, **catalog_more.QUERIES}.items():
    df = fn(spark, sf)
    d = summarise(df._jdf.queryExecution().executedPlan().toString())
    rows.append((name, d))
out = ["# Physical plans of the registered queries", "",
       "Generated with `tools/plan_report.py` on sf0.01 (`local[8]`, AQE on; the plans are shown before AQE re-planning).",
       "Columns: round-robin exchanges, hash exchanges, single-partition exchanges, broadcast exchanges, window operators, Arrow Python nodes,",
       "sort-merge joins. Queries with checkpointed loops (beam, generation, BPE) show only the plan after their last checkpoint.", "",
       "| query | round robin | hash exch. | single part. | broadcast | windows | Arrow Python | SMJ | scan columns |", "|---|---|---|---|---|---|---|---|---|"]
for name, d in rows:
    scans = "; ".join(sorted(set(s.replace("struct<", "").replace(">", "") for s in d["scans"])))
    out.append(f"| {name} | {d['round_robin']} | {d['hash_exchange']} | {d['single_partition']} | {d['broadcast']} | {d['windows']} | {d['arrow_python']} | {d['sort_merge_join']} | {scans} |")
out += ["", "The single-partition exchange in `shuffle_batch` and `masked_loss` is the window over the",
        "bucket-count summary (epochs x buckets rows), not over the data.", ""]
for name in ["prepare_corpus", "shuffle_batch", "cross_entropy"]:
    df = catalog.QUERIES[name](spark, sf)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    # keep the operator tree, not the per-node detail
    tree = text.split("\n(1)")[0]
    out += [f"## {name}", "", "```", tree.strip(), "```", ""]
open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write("\n".join(out))
spark.stop()
