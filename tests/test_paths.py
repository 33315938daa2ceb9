import random

import pytest

from pagestrata.operators.paths import Path, nodes_at, select
from pagestrata.sources.nodes import explode_nodes
from pagestrata.sources.page_tree import NodeRequest
from pagestrata.sources.tables import Staging

TAGS = ["div", "span", "ul", "li", "a", "em"]
REQUEST = NodeRequest(elements=dict.fromkeys(TAGS, ()), text=dict.fromkeys(TAGS, ()), attributes=None)


def page(rng):
    def inner(depth):
        out = ""
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(TAGS)
            if t != "a" or depth < 4:
                out += f"<{t} class={rng.choice('xyz')}>{inner(depth + 1) if depth < 4 and t not in ('a', 'em') else ''}</{t}>"
        return out

    return "<div>" + "".join(inner(0) for _ in range(3)) + "</div>"


def related(axis, s, x):
    end = lambda n: n["post"] + n["depth"]
    return {
        "child": x["parent_pre"] == s["pre"],
        "parent": s["parent_pre"] == x["pre"],
        "descendant": s["pre"] < x["pre"] <= end(s),
        "ancestor": x["pre"] < s["pre"] <= end(x),
        "following": x["pre"] > end(s),
        "preceding": s["pre"] > end(x),
        "following_sibling": x["parent_pre"] == s["parent_pre"] and x["pre"] > s["pre"],
        "preceding_sibling": x["parent_pre"] == s["parent_pre"] and x["pre"] < s["pre"],
    }[axis]


def brute(rows, path, start=None):
    """Elements that the path leads to, element by element; a condition is a class."""
    now = start
    for step in path.steps:
        fits = [x for x in rows if (not step.tags or x["tag"] in step.tags) and (step.where is None or x["class"] == "x")]
        fits = [x for x in fits if step.having is None or brute(rows, step.having, [x])]
        found = {}
        if now is None:
            found = {x["pre"]: x for x in fits if step.axis == "descendant" or x["parent_pre"] == -1}
        for s in now or ():
            met = [x for x in fits if related(step.axis, s, x)]
            for x in met[step.nth - 1 : step.nth] if step.nth else met:
                found[x["pre"]] = x
        now = [found[k] for k in sorted(found)]
    return now


X = "class = 'x'"
PATHS = [
    Path().descendant("ul").child("li"),
    Path().descendant("ul").descendant("li", having=Path().descendant("a")),
    Path().descendant("div").child("span", nth=2),
    Path().descendant("li", where=X).ancestor("div"),
    Path().descendant("em").parent("span", "div").following_sibling("a", nth=1),
    Path().descendant("em", where=X).following("a", nth=1),
    Path().descendant("ul").following("em", where=X),
    Path().descendant("a").preceding("ul", having=Path().child("li").child("em")),
    Path().descendant("span").preceding_sibling(),
    Path().child("div").child("ul", having=Path().following_sibling("div")),
    Path().descendant("div", having=Path().ancestor("ul")).child("div", where=X, having=Path().parent("div", where=X)),
]


def test_paths_equal_brute_force(spark, pages_of):
    rng = random.Random(3)
    with Staging(spark) as staging:
        nodes = staging.store(explode_nodes(pages_of(*[page(rng) for _ in range(30)]), REQUEST), "nodes")
        rows = {}
        for r in nodes.orderBy("page_id", "pre").collect():
            rows.setdefault(r["page_id"], []).append(r)
        met = 0
        for path in PATHS:
            want = sorted((p, x["pre"]) for p, of in rows.items() for x in brute(of, path))
            got = sorted((r["page_id"], r["pre"]) for r in nodes_at(nodes, path).collect())
            assert got == want, [s.axis for s in path.steps]
            met += len(want)
        assert met > 100


def test_one_shuffle_for_all_steps(spark, pages_of):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        nodes = explode_nodes(pages_of("<ul><li><a>x</a></ul>"), REQUEST)
        plan = select(nodes, PATHS[7], "s")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(page_id") == plan.count("Exchange") == 1


def test_what_cannot_be_counted_is_refused():
    for how in (dict(axis="ancestor", nth=1), dict(axis="following", nth=2), dict(axis="nowhere")):
        with pytest.raises(ValueError):
            Path().step(how.pop("axis"), "a", **how)
