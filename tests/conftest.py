import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rankwalk.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# Fixture graphs (fixed values): two 5-node textbook graphs and the 11-node
# test graph as adjacency text.
TOY1 = {"nodes": ["A", "B", "C", "D", "E"],
        "edges": [("A", "B"), ("A", "D"), ("B", "C"), ("B", "E"), ("C", "D"),
                  ("D", "E"), ("E", "A"), ("E", "B"), ("E", "C")]}
TOY2 = {"nodes": ["A", "B", "C", "D", "E"],
        "edges": [("A", "B"), ("A", "C"), ("A", "D"), ("B", "D"),
                  ("B", "E"), ("C", "A"), ("C", "E"), ("D", "B")]}
TEST11_LINES = [
    "2\t{'3': 1}",
    "3\t{'2': 1}",
    "4\t{'2': 1, '1': 1}",
    "5\t{'4': 3, '2': 1, '6': 1}",
    "6\t{'2': 1, '5': 2}",
    "7\t{'2': 1, '5': 1}",
    "8\t{'2': 1, '5': 1}",
    "9\t{'2': 1, '5': 1}",
    "10\t{'5': 1}",
    "11\t{'5': 1}",
]


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="rankwalk-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path
