"""Plans that stay within the driver's memory over large tables."""

import re
from pathlib import Path

import pytest

from loomset.frames import table
from loomset.operators import resolve
from loomset.plans import emit, model_queries
from loomset.plans.model import materialised, nested

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ends_of_names_are_not_broadcast(spark):
    """They are many a name, but Spark takes them for as large as the names, which the driver would collect them for."""
    name = spark.range(50).selectExpr("concat('Name', id) AS name")
    x = resolve.ending_with(name.selectExpr("substring(name, 3) AS wanted"), name)
    assert "BroadcastHashJoin" not in plan(x)
    assert {(r.wanted, r.fits, r.only) for r in x.collect()} == {(f"me{i}", 1, f"Name{i}") for i in range(50)}


def test_pieces_of_names_are_not_broadcast(spark):
    """Each name has dozens of pieces, which the merge of packages joins."""
    name = spark.range(20).selectExpr("concat('Package', id) AS a")
    x = resolve.similar(name, name.withColumnRenamed("a", "b"), 1)
    assert "BroadcastHashJoin" not in plan(x)
    assert x.where("a = b").count() == 20


@tables
def test_tables_of_the_model_are_not_broadcast(spark):
    """Their files are many times smaller than they are."""
    m = nested(table(spark, SF, "ontology_ir"))
    assert "BroadcastHashJoin" not in plan(m.named())
    assert "BroadcastHashJoin" not in plan(materialised(m.corpus()).named())


@tables
def test_references_are_not_broadcast(spark):
    """A union of two tables; what they name is decided by its real size."""
    x = resolve.cross_package_refs(nested(table(spark, SF, "ontology_ir")))
    assert not re.search(r"BroadcastHashJoin \[doc_id#\d+L, pkg_ord", plan(x))


@tables
def test_steps_of_the_merge_are_not_planned_again_for_each_table(spark):
    """Four tables are joined with the classes that stay, whose steps were in the plan of each, six of which were worked out at a time."""
    m = nested(table(spark, SF, "ontology_ir"))
    for own in (resolve.merged_packages(m), resolve.without_copies(m)):
        for t in (own.classes, own.parent, own.attribute, own.association):
            assert (p := plan(t).split("Initial Plan")[0]).count("Join ") == 1
            assert "Window" not in p and "Aggregate" not in p and "BroadcastHashJoin" not in p


@tables
def test_forms_are_probed_by_plans_of_their_own(spark):
    """What all forms hold would else be one plan of all their steps."""
    assert plan(model_queries.consistent_names(spark, SF)).split("Initial Plan")[0].count("Join ") == 2


@tables
def test_forms_are_written_by_plans_of_their_own(spark):
    """What is done with files of all forms would else be one plan of all their steps."""
    assert "Join" not in plan(emit.emitted(nested(table(spark, SF, "ontology_ir"))))
