"""Rank values for listings.

The order of a remote listing is not published, so these are definitions of
this package, each deterministic and computed from stored columns:

=============  ===============================================================
new            creation time
top            score
hot            ``sign(s) * log10(max(|s|, 1)) + epoch / decay``
rising         ``s / (age in hours + 2) ^ gravity``
controversial  ``(ups + downs) ^ (min(ups, downs) / max(ups, downs))``, 0 when
               either side is not positive
=============  ===============================================================

With an upvote ratio ``r`` other than one half, ``ups + downs = s / (2r - 1)``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import epoch_seconds


def hot(score: Column, created: Column, decay: float = 45_000.0) -> Column:
    s = score.cast("double")
    magnitude = F.log10(F.greatest(F.abs(s), F.lit(1.0)))
    return F.signum(s) * magnitude + epoch_seconds(created) / F.lit(decay)


def rising(score: Column, created: Column, as_of: Column, gravity: float = 1.8) -> Column:
    hours = (epoch_seconds(as_of) - epoch_seconds(created)) / F.lit(3600.0)
    # Posts newer than the reference moment count as brand-new.
    age = F.greatest(hours, F.lit(0.0)) + F.lit(2.0)
    return score.cast("double") / F.pow(age, F.lit(gravity))


def votes(score: Column, ratio: Column) -> tuple[Column, Column]:
    """Up and down votes; null where the ratio is one half or unknown."""
    spread = F.lit(2.0) * ratio - F.lit(1.0)
    total = F.when(spread != 0, score.cast("double") / spread)
    return ratio * total, (F.lit(1.0) - ratio) * total


def controversial(ups: Column, downs: Column) -> Column:
    even = F.least(ups, downs) / F.greatest(ups, downs)
    contested = (ups > 0) & (downs > 0)
    return F.when(contested, F.pow(ups + downs, even)).otherwise(F.lit(0.0))
