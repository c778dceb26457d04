"""A choice of the registered queries against their SQL on the smallest tables; the driver runs all of them."""

import pytest
from oracle import same

from weftgraph.plans import registry

SF = "/root/testdata/sf0.001"
SOME = (
    "graph_nodes", "graph_edges", "graph_degrees", "graph_merge_edges", "graph_upsert_edges", "graph_save_load", "triple_log_replay", "backup_prune", "relation_report", "link_extraction", "crawl_level", "crawl_loop", "cleaned_pages", "node_to_node", "resume_offset",
    "source_url_recovery", "block_batches", "er_similarity", "er_components", "er_canonical", "chain_sampling", "path_triples_reverse", "cross_referencing", "clue_packages", "path_expansion", "json_recovery", "extraction_prompts",
    "leak_check", "numbered_reply_lines", "pattern_reply_lines", "chain_validation", "final_records", "verdicts", "dataset_summary", "traditional_format", "streaming_ingest",
)


def test_every_query_with_sql_is_registered():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.FLAGSHIP in registry.queries()


@pytest.mark.parametrize("name", SOME)
def test_query(spark, name):
    same(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF)
