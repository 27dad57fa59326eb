"""Every registered query against its SQL, and its plan."""

import pytest

from contactweave.functions import storage
from contactweave.jobs.catalog import QUERIES
from contactweave.jobs.oracles import ORACLES
from contactweave.operators import sites
from contactweave.sources import bam, bindings


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, same_as_sql, name):
    same_as_sql(QUERIES[name](spark, sf), ORACLES[name])


@pytest.mark.parametrize("name", ["draft_edges", "bam_filter", "pairs_filter", "recover_contigs", "cluster_linkage", "order_score", "orientation_costs", "allele_row_candidates", "agp"])
def test_plan_has_no_nested_loops(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = QUERIES["link_counts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in line]
    assert scans and all("l_extendedprice" not in line for line in scans)


@pytest.mark.parametrize(("name", "table", "scans"), [("site_ranges", "documents", 1), ("motif_counts", "documents", 1), ("motif_positions", "documents", 1), ("bam_filter", "orders", 0)])
def test_tables_are_read_once(spark, sf, monkeypatch, name, table, scans):
    """In the query's plan and in those of the tables it stores on the way."""
    plans = []

    def kept(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return storage.stored(df, *more)

    monkeypatch.setattr(sites, "stored", kept)
    plans.append(QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString())
    assert sum("FileScan" in line and f"/{table}.parquet" in line for plan in plans for line in plan.splitlines()) == scans


def test_scaffolds_are_whole(spark, sf):
    """One row a scaffold, with all its contigs' bases in order: nothing is left for a reader to put together."""
    got = QUERIES["scaffold_fasta"](spark, sf)
    assert got.columns == ["object", "seq"] and got.count() == got.select("object").distinct().count() == 16
    sizes = QUERIES["reverse_complements"](spark, sf).selectExpr("sum(length(seq)) AS n").first().n
    assert got.selectExpr("sum(length(seq)) AS n").first().n == sizes


def test_items_are_paired_by_tasks_of_bounded_size(spark, sf, monkeypatch):
    """Their number follows the table, whatever the session's partitions; pairs are not joined with contigs again."""
    monkeypatch.setattr(bindings, "ITEMS", 1000)
    plan = QUERIES["link_counts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    n = bindings.table(spark, sf, "lineitem").count() // 1000 + 1
    assert any("hashpartitioning(l_orderkey" in x and f", {n}), REPARTITION_BY_NUM" in x for x in plan.splitlines())


def test_alignments_are_decoded_once(spark, sf):
    """The read filter adds no scan to those of its alignments and its windows."""
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans(QUERIES["bam_filter"](spark, sf)) == scans(QUERIES["range_semi_join"](spark, sf))


def test_few_files_of_alignments(spark, sf, monkeypatch):
    """Files, each of which names its contigs, are no more than the cores for small tables, however many tasks pair items."""
    found = []
    monkeypatch.setattr(bindings, "ITEMS", 100)
    monkeypatch.setattr(bam, "references", lambda rows, of=bam.references: found.append(of(rows)) or found[0])
    assert QUERIES["bam_alignments"](spark, sf).count() == bindings.alignments(spark, sf).count()
    assert 1 <= found[0].select("file").distinct().count() <= spark.sparkContext.defaultParallelism


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
