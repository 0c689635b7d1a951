"""rankwalk - link analysis on Spark DataFrames: adjacency sources, graph
construction and EDA, Markov-chain operators, PageRank and ranked reports."""

__version__ = "0.1.0"
