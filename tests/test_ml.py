"""Stratified folds are balanced to +-1 per class; the baseline is the majority share."""

from collections import Counter

from conftest import SF001
from pitchline.plans import ml, outcomes
from pitchline.plans.catalog import Tables


def test_stratified_folds_balanced(spark):
    t = Tables(spark, SF001)
    feats = outcomes.ml_features(outcomes.team_outcomes(t.matches), t.m1(), t.m2(), t.m3(), t.m4())
    rows = ml.stratified_folds(feats).select("outcome_class", "fold").collect()
    by_class = {}
    for r in rows:
        by_class.setdefault(r.outcome_class, Counter())[r.fold] += 1
    for cls, c in by_class.items():
        counts = [c.get(f, 0) for f in range(ml.N_FOLDS)]
        assert max(counts) - min(counts) <= 1, (cls, counts)
    base = ml.majority_baseline(feats).first()
    sizes = Counter(r.outcome_class for r in rows)
    assert base.n_samples == len(rows) and base.majority_count == max(sizes.values())
