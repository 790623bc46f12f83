"""Property: TF-IDF over random count grids equals the formulas computed in Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.operators import tfidf as TF

TERMS = ["t1", "t2", "t3"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 6)] * 3), min_size=1, max_size=25))
def test_tfidf_equals_formulas(spark, grid):
    wide = spark.createDataFrame([(i, *row) for i, row in enumerate(grid)],
                                 "doc int, " + ", ".join(f"{t} int" for t in TERMS))
    long = TF.term_counts_long(wide, ["doc"], TERMS)
    idf = TF.idf(TF.document_frequency(long), TF.n_documents(wide))
    got = {(r.doc, r.term): r.tfidf for r in TF.tfidf(long, idf).collect()}
    n = len(grid)
    for j, t in enumerate(TERMS):
        df = sum(1 for row in grid if row[j] > 0)
        w_idf = math.log10(n / df) if df else None
        for i, row in enumerate(grid):
            tf = 1 + math.log10(row[j]) if row[j] > 0 else 0.0
            want = None if w_idf is None else tf * w_idf
            g = got[(i, t)]
            assert (g is None and want is None) or abs(g - want) < 1e-12, (i, t, g, want)
