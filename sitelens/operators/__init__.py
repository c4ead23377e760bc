"""DataFrame operators: lines and tokens, index, search, link graph, traffic."""
