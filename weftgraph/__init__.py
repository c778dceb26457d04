"""weftgraph: knowledge graphs and multi-hop question sets as Spark DataFrame plans."""
