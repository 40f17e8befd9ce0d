import os
import tempfile

import numpy as np

from conftest import TINY
from sparkmine.plans.experiments import SweepRow
from sparkmine.plans.programs import apriori_program, kmeans_program, son_program


def _text(lines):
    d = tempfile.mkdtemp(prefix="sm-prog-")
    path = os.path.join(d, "data.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_apriori_program(spark):
    rep = apriori_program(spark, _text([" ".join(map(str, t)) for t in TINY]), 2)
    assert rep.n == 9 and rep.equal and rep.itemsets.count() == 13
    assert sorted(tuple(r) for r in rep.candidate_growth.collect()) == [(1, 5), (2, 10), (3, 2), (4, 0)]


def test_son_program(spark):
    out = tempfile.mkdtemp(prefix="sm-son-")
    runs, cands = son_program(spark, _text([" ".join(map(str, t)) for t in TINY]), [SweepRow(2 / 9, 3)], out)
    assert runs.first()["n_itemsets"] == 13
    assert os.path.isdir(os.path.join(out, "runs")) and os.path.isdir(os.path.join(out, "run_candidates"))


def test_kmeans_program(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(loc=c, scale=0.3, size=(20, 3)) for c in ([0, 0, 0], [6, 6, 6])])
    imgs = _text([" ".join(f"{v:.4f}" for v in row) for row in x])
    labels = _text([str(i // 20) for i in range(40)])
    rep = kmeans_program(spark, imgs, labels, k=2, batch_size=10, max_iter=5, seed=1)
    assert rep.nmi > 0.99 and rep.sse > 0 and rep.assignment.count() == 40
