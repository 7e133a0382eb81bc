"""DataFrame operators: search, threads, links, clusters, conversations, time."""
