"""Queries read whole inputs."""

from tessera import queries as own


def test_frontier_reads_past_the_start_of_a_text(spark, tmp_path):
    text = "Anat " + "x" * 3000 + " Zebra ends it."
    spark.createDataFrame([(text,)], "text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert ("zebra", "Anat") in {tuple(r) for r in own.frontier_expansion(spark, str(tmp_path)).select("topic", "lineage").collect()}


def test_communities_and_track_take_the_whole_graph(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    whole = own.relations(spark, small)
    nodes = {r[0] for r in whole.select("source_id").union(whole.select("target_id")).collect()}
    assert {r.node for r in own.kg_communities(spark, small).select("node").collect()} == nodes
    monkeypatch.setattr(own.tracks, "graph_track", lambda e, r, *_, **__: (e.count(), r.count()))
    assert own.graph_track(spark, small) == (own.entities(spark, small).count(), whole.count())
