"""The fits of a cross-validation share one stored vector."""

from __future__ import annotations

import catalog.models as catalog_models
from catalog import QUERIES
from panelwright.plans import validation

SF_DIR = "/root/testdata/sf0.001"


def test_folds_read_a_stored_vector(spark, monkeypatch):
    # every pass of every fit assembled the features anew.
    seen, score = [], validation.cross_validate

    def kept(problem, *args, **named):
        seen.append((problem, args))
        return score(problem, *args, **named)

    monkeypatch.setattr(validation, "cross_validate", kept)
    found = {r["measure"]: r["value"] for r in QUERIES["cv_model"](spark, SF_DIR).collect()}
    (read, args), = seen
    assert read.matrix is not None and set(read.matrix.places) == set(catalog_models.START)
    # Few rows, so that Spark reads all of them for its splits: the same fits on the columns themselves.
    wide = score(catalog_models.problem(spark, SF_DIR), *args)
    assert found == {"score": wide.score, "score_std": wide.score_std, "score_train": wide.score_train, "rounds": float(wide.rounds)}
