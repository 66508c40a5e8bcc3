"""Role-dependent masks as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import ColumnOrName, _col

Mask = Callable[[ColumnOrName, str], Column]


def mask_email(value: ColumnOrName, role: str, strict: bool = False,
               clear_roles: Sequence[str] = S.CLEAR_TEXT_ROLES) -> Column:
    """The first character and the domain; ``***`` stands for what lies between.

    A text without ``@`` has no domain, so its "last part" is the whole text and shows up after
    the mask; ``strict`` hides such texts fully instead.
    """
    v = _col(value)
    if role in clear_roles:
        return v
    shown = F.concat(F.left(v, F.lit(1)), F.lit("***@"), F.split_part(v, F.lit("@"), F.lit(-1)))
    return F.when(~F.contains(v, F.lit("@")), F.lit(S.MASK)).otherwise(shown) if strict else shown


def mask_whole(value: ColumnOrName, role: str,
               clear_roles: Sequence[str] = S.CLEAR_TEXT_ROLES) -> Column:
    """Known values become a fixed text; NULL stays NULL."""
    v = _col(value)
    return v if role in clear_roles else F.when(v.isNotNull(), F.lit(S.MASK))


mask_tax_id = mask_whole
mask_pii_text = mask_whole
