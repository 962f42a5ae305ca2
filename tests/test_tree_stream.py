"""Added and changed files of a tree appear once, across restarts."""

import os
import tempfile
import time

from quire.sources import tree
from quire.streaming.prepare import latest_tree_text, start_tree_stream

from test_tree import make_tree


def put(root, rel, data):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_offsets_cut_the_changes_into_batches_without_gap_or_overlap():
    root = make_tree({f"d{i % 3}/f{i}.py": b"x\n" for i in range(30)})
    reader = tree.SourceTreeStreamReader({"path": root, "repo": "r", "settleSeconds": "0"}, None)
    times = sorted(tree._LocalFs().changed(os.path.join(root, f"d{i % 3}/f{i}.py")) for i in range(30))
    cuts = [0, times[4], times[4], times[20], times[-1]]
    seen = []
    for a, b in zip(cuts, cuts[1:]):
        batch = [r[1] for p in reader.partitions({"changed": a}, {"changed": b}) for r in reader.read(p)]
        again = [r[1] for p in reader.partitions({"changed": a}, {"changed": b}) for r in reader.read(p)]
        assert sorted(batch) == sorted(again)  # a batch that is repeated is the same
        seen += batch
    assert sorted(seen) == sorted(f"d{i % 3}/f{i}.py" for i in range(30))
    assert reader.initialOffset() == {"changed": 0} and reader.latestOffset()["changed"] >= times[-1]


def test_added_and_changed_files_appear_once_across_restarts(spark):
    root, out = make_tree({"a.py": b"a1\n", "d/b.md": b"b1\n", "skip.txt": b"no\n"}), os.path.join(tempfile.mkdtemp(prefix="quire-ts-"), "out")
    name = f"tree-test-{time.time_ns()}"

    def run():
        time.sleep(0.3)  # beyond the settling time
        q = start_tree_stream(spark, root, out, "r", name=name, num_partitions=2, settle_seconds=0.1)
        assert q.awaitTermination(120)
        rows = spark.read.option("basePath", out).parquet(out).collect() if os.path.isdir(out) else []
        return sorted((r.path, r.text.split("\n")[-1].rsplit("<|message|>", 1)[-1] or r.text) for r in rows), len(rows)

    assert run()[1] == 2
    assert run()[1] == 2  # nothing new
    put(root, "a.py", b"a2\n")
    put(root, "e/f/new.py", b"n1\n")
    os.rename(os.path.join(root, "skip.txt"), os.path.join(root, "kept.py"))  # an old file under a name that counts
    assert run()[1] == 5
    os.unlink(os.path.join(root, "d/b.md"))
    assert run()[1] == 5
    latest = {r.path: r.text for r in latest_tree_text(spark, out).collect()}
    assert sorted(latest) == ["a.py", "d/b.md", "e/f/new.py", "kept.py"] and "a2" in latest["a.py"] and "a1" not in latest["a.py"]
