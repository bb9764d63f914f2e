"""Content-based recommendation: plays with song features, a model per listener, ranked songs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from earshot.operators.features import drop_nan
from earshot.operators.regression import fit_gradient_descent, fit_ols, labelled
from earshot.operators.scoring import recommend_top_n
from earshot.session import stage


def recommend_by_content(
    plays: DataFrame, songs: DataFrame, features: Sequence[str], n: int = 10, method: str = "descent",
    required: Sequence[str] | None = None, **settings,
) -> DataFrame:
    """``(user_id, song_id, score, place)``: the best unheard songs by each listener's own model.

    Both the training rows and the scored songs must have all ``required``
    features, by default every feature.
    """
    usable = drop_nan(songs, list(required or features))
    fit = {"descent": fit_gradient_descent, "exact": fit_ols}[method]
    models = fit(stage(labelled(plays, usable, features), "labelled"), features, **settings)
    return recommend_top_n(models, usable, features, plays, n)
