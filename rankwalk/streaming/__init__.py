from .adjacency import (read_adjacency_stream, running_degree_stats, running_out_degree,
                        start_to_memory)

__all__ = ["read_adjacency_stream", "running_degree_stats", "running_out_degree", "start_to_memory"]
