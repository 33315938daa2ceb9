"""Selecting elements by where they are: steps along axes, put together like column expressions.

``nodes_at(nodes, Path().descendant("table").descendant("tr", having=Path().descendant("a")))``
are the rows of tables that hold a link. A step keeps the elements that stand in
the named relation to one that the step before kept, have one of the tags, meet
``where`` (a condition on the columns of an element, as a column or SQL) and, for ``having``, from
which another path leads somewhere. ``nth`` counts children of one element, or,
for the axes that follow, takes the first one behind each element.

Every step is a window over the elements of a page: an element lies in another
when it starts behind it and not behind its end. No pairs of elements are formed,
and the plan has one shuffle for all steps, by page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.operators.axes import last_pre

#: Axes and their inverses.
INVERSE = {
    "child": "parent",
    "descendant": "ancestor",
    "following": "preceding",
    "following_sibling": "preceding_sibling",
}
INVERSE |= {v: k for k, v in INVERSE.items()}
#: Columns that conditions may use.
COLUMNS = ["page_id", "pre", "post", "depth", "parent_pre", "tag", "class", "attrs", "href"]


@dataclass(frozen=True, eq=False)
class Step:
    axis: str
    tags: tuple[str, ...]
    where: Column | str | None = None
    having: Path | None = None
    nth: int | None = None


class Path:
    """Steps from the top of the page, or from the element that a ``having`` is about."""

    def __init__(self, steps: tuple[Step, ...] = ()):
        self.steps = steps

    def step(self, axis: str, *tags: str, where: Column | str | None = None, having: Path | None = None, nth: int | None = None) -> Path:
        if axis not in INVERSE:
            raise ValueError(f"no axis {axis!r}")
        if nth is not None and (axis not in ("child", "following", "following_sibling") or axis != "child" and nth != 1):
            raise ValueError(f"{axis} cannot count to {nth}")
        return Path((*self.steps, Step(axis, tags, where, having, nth)))

    def child(self, *tags: str, **how) -> Path:
        return self.step("child", *tags, **how)

    def descendant(self, *tags: str, **how) -> Path:
        return self.step("descendant", *tags, **how)

    def parent(self, *tags: str, **how) -> Path:
        return self.step("parent", *tags, **how)

    def ancestor(self, *tags: str, **how) -> Path:
        return self.step("ancestor", *tags, **how)

    def following(self, *tags: str, **how) -> Path:
        return self.step("following", *tags, **how)

    def preceding(self, *tags: str, **how) -> Path:
        return self.step("preceding", *tags, **how)

    def following_sibling(self, *tags: str, **how) -> Path:
        return self.step("following_sibling", *tags, **how)

    def preceding_sibling(self, *tags: str, **how) -> Path:
        return self.step("preceding_sibling", *tags, **how)


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _two_roles(rows: DataFrame, first: Column, second: Column) -> DataFrame:
    """Every element twice, under two places: ``role`` 0 and 1, ``slot`` the place."""
    roles = F.array(*[F.struct(F.lit(k).alias("role"), s.cast("long").alias("slot")) for k, s in enumerate((first, second))])
    return rows.withColumn("_r", F.explode(roles)).withColumns({"_role": F.col("_r.role"), "_slot": F.col("_r.slot")}).drop("_r")


def _reached(rows: DataFrame, axis: str, inside: str, name: str) -> DataFrame:
    """Adds ``name``: does an element stand in ``axis`` to one that is ``inside``?"""
    pre, end, on = F.col("pre"), last_pre(), F.col(inside)
    page = Window.partitionBy("page_id")
    before = page.orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    after = page.orderBy(pre.desc()).rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy("page_id", "parent_pre")
    if axis == "descendant":
        return rows.withColumn(name, _known(F.max(F.when(on, end)).over(before) >= pre))
    if axis == "ancestor":
        return rows.withColumn(name, _known(F.last(F.when(on, pre), ignorenulls=True).over(after) <= end))
    if axis == "following":
        return rows.withColumn(name, _known(F.min(F.when(on, end)).over(page) < pre))
    if axis == "preceding":
        return rows.withColumn(name, _known(F.max(F.when(on, pre)).over(page) > end))
    if axis in ("following_sibling", "preceding_sibling"):
        order = pre if axis == "following_sibling" else pre.desc()
        earlier = family.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, _known(F.max(on).over(earlier)))
    # A parent and its children meet under the parent's place.
    asks, tells = (1, 0) if axis == "child" else (0, 1)
    both = _two_roles(rows, pre, F.col("parent_pre"))
    met = F.max(F.when(F.col("_role") == tells, on)).over(Window.partitionBy("page_id", "_slot"))
    return both.withColumn(name, _known(met)).where(F.col("_role") == asks).drop("_role", "_slot")


def _first_behind(rows: DataFrame, axis: str, inside: str, fits: str, name: str) -> DataFrame:
    """Adds ``name``: is an element the first that ``fits`` behind one that is ``inside``?"""
    on, fit, pre = F.col(inside), F.col(fits), F.col("pre")
    if axis == "following_sibling":
        earlier = Window.partitionBy("page_id", "parent_pre").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
        latest, rival = F.max(F.when(on, pre)).over(earlier), F.max(F.when(fit, pre)).over(earlier)
        return rows.withColumn(name, _known(fit & (latest >= F.coalesce(rival, F.lit(-1)))))
    both = _two_roles(rows, pre, last_pre())  # an element begins in one place and is behind us in another
    earlier = Window.partitionBy("page_id").orderBy("_slot", "_role").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.max(F.when((F.col("_role") == 1) & on, F.col("_slot"))).over(earlier)
    rival = F.max(F.when((F.col("_role") == 0) & fit, F.col("_slot"))).over(earlier)
    found = _known(fit & (ended >= F.coalesce(rival, F.lit(-1))))
    return both.withColumn(name, found).where("_role = 0").drop("_role", "_slot")


def _fits(rows: DataFrame, step: Step, name: str) -> DataFrame:
    """Adds ``name``: what a step asks of an element itself."""
    fit = F.col("tag").isin(*step.tags) if step.tags else F.lit(True)
    if step.where is not None:
        fit = fit & _known(F.expr(step.where) if isinstance(step.where, str) else step.where)
    if step.having is not None:
        rows = _leads(rows, step.having, f"{name}h")
        fit = fit & F.col(f"{name}h")
    return rows.withColumn(name, fit)


def _leads(rows: DataFrame, path: Path, name: str) -> DataFrame:
    """Adds ``name``: does ``path`` lead anywhere from an element? Found from its end, by the inverse axes."""
    inside = None
    for k, step in reversed(list(enumerate(path.steps))):
        if step.nth is not None:
            raise ValueError("no counting inside having")
        rows = _fits(rows, step, f"{name}f{k}")
        here = F.col(f"{name}f{k}") if inside is None else F.col(f"{name}f{k}") & F.col(inside)
        rows = _reached(rows.withColumn(f"{name}w{k}", here), INVERSE[step.axis], f"{name}w{k}", f"{name}r{k}")
        inside = f"{name}r{k}"
    return rows.withColumn(name, F.col(inside) if inside else F.lit(True))


def select(rows: DataFrame, path: Path, name: str) -> DataFrame:
    """Adds ``name``: is an element what ``path`` leads to from the top of its page?

    Elements that were not asked of the reader are not there for any step; children of the page count as without parent.
    """
    rows = rows.repartition("page_id")  # serves every window below
    inside = None
    for k, step in enumerate(path.steps):
        fits, out = f"{name}f{k}", f"{name}o{k}"
        rows = _fits(rows, step, fits)
        if inside is None:  # from the top of the page everything is a descendant
            top = F.col("parent_pre") == -1 if step.axis == "child" else F.lit(step.axis == "descendant")
            rows = rows.withColumn(out, F.col(fits) & top)
        elif step.nth is not None and step.axis != "child":
            rows = _first_behind(rows, step.axis, inside, fits, out)
        else:
            rows = _reached(rows, step.axis, inside, f"{out}r")
            rows = rows.withColumn(out, F.col(fits) & F.col(f"{out}r"))
        if step.nth is not None and step.axis == "child":
            order = Window.partitionBy("page_id", "parent_pre", out).orderBy("pre")
            rows = rows.withColumn(out, F.col(out) & (F.row_number().over(order) == step.nth))
        inside = out
    return rows.withColumn(name, F.col(inside) if inside else F.lit(True))


def nodes_at(nodes: DataFrame, path: Path) -> DataFrame:
    """The rows of ``nodes`` that ``path`` leads to. Steps see places only; the rows are fetched when they are known."""
    slim = nodes.where(F.col("tag").isNotNull() & (F.col("pre") >= 0)).select(*COLUMNS)
    found = select(slim, path, "_s").where("_s").select("page_id", "pre")
    return nodes.join(found, ["page_id", "pre"], "left_semi")
