"""The shop workload: given tables mapped onto the shop's tables and topics, queries over them, and their oracles."""
