"""The paged source: any number of pages, each read by one task."""
import json
import os

import pytest

from strata.session import scratch_path
from strata.sources.paged import read_pages


def write(root, pages):
    root = root.removeprefix("file:")
    os.makedirs(root, exist_ok=True)
    for number, rows in pages.items():
        os.makedirs(f"{root}/page={number}")
        with open(f"{root}/page={number}/part-0.txt", "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows))


@pytest.mark.parametrize("pages", [0, 1, 2, 100])
def test_reads_until_the_first_empty_page(spark, pages):
    root = scratch_path(spark, "pages")
    write(root, {p: [{"id": p * 3 + i, "name": f"n{i}", "more": 1} for i in range(3)] for p in range(pages)} | {pages: []})
    df = read_pages(spark, root, "id long, name string", pages_per_task=7)
    assert sorted(r.id for r in df.collect()) == list(range(3 * pages))
    assert df.rdd.getNumPartitions() == max(1, -(-pages // 7))


def test_first_page_missing_fields_and_no_empty_page(spark):
    root = scratch_path(spark, "pages")
    write(root, {1: [{"id": 1}], 2: [{"name": "b", "id": 2}]})
    rows = read_pages(spark, root, "id long, name string", first_page=1).collect()
    assert sorted(rows) == [(1, None), (2, "b")]
    assert read_pages(spark, root, "id long, name string").collect() == []  # no page 0


def test_gap_is_an_error_not_a_loss(spark):
    root = scratch_path(spark, "pages")
    write(root, {p: [{"id": p}] for p in range(16) if p != 5})
    with pytest.raises(Exception, match="page 5"):
        read_pages(spark, root, "id long").collect()
