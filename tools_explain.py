"""Print the physical plans of the headline plans (``explain("formatted")`` trimmed to operators).

Usage: python tools_explain.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.operators import evaluate as E  # noqa: E402
from quire.operators import retrieve as R  # noqa: E402
from quire.operators.util import stored as stored_table  # noqa: E402
from quire.plans import pipeline as P  # noqa: E402
from quire.session import local_session, scratch_path  # noqa: E402
from quire.sinks.writers import write_index  # noqa: E402
from quire.sources.readers import read_index  # noqa: E402


def tree(df) -> str:
    """The operator tree of the executed (final adaptive) plan, one operator per line."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Initial Plan ==" in text:
        text = text.split("== Initial Plan ==")[0]
    out = []
    for line in text.split("\n"):
        m = re.match(r"^([\s:+\-]*)(\S.*)$", line)
        if not m or "== Final Plan ==" in line:
            continue
        prefix, rest = m.groups()
        cg = re.match(r"^\*\((\d+)\)\s*(.*)$", rest)
        if cg:
            rest = cg.group(2)
        name = re.split(r"[\[(]", rest, maxsplit=1)[0].strip()
        if cg:
            name = f"*({cg.group(1)}) {name}"
        detail = ""
        for key in ("PushedFilters", "PartitionFilters", "ReadSchema"):
            k = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", rest)
            if k:
                detail += f" {key}: {k.group(1)[:120]}"
        if "dynamicpruning" in rest:
            detail += " (dynamic pruning)"
        out.append(prefix + name + detail)
    return "\n".join(out)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    idx = P.index(spark, sf)
    print("## Index build (postings with df, idf, weight, norm)\n\n```\n" + tree(idx.postings) + "\n```\n")
    path = scratch_path(spark, "explain-index")
    write_index(idx, path, buckets=16)
    stored = read_index(spark, path)
    q = P.benchmark_queries(spark, sf)
    terms = stored_table(R.query_terms(q), "terms")
    print("## Lookup of the query terms in a stored, bucketed index\n\n```\n" + tree(R.matches(terms, stored)) + "\n```\n")
    print("## Scores and top 10 per query, from the matches\n\n```\n" + tree(R.search(stored, q)) + "\n```\n")
    res = R.search(stored, q)
    print("## MAP/MAR (judgements by fingerprint join)\n\n```\n" + tree(E.map_mar(E.ranked_ids(E.doc_names(res)), P.qrels(spark, sf))) + "\n```\n")


if __name__ == "__main__":
    main(sys.argv)
