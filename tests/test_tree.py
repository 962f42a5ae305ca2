"""Source trees: names kept and dropped, byte decoding, sizes, unreadable files, early stop."""

import os
import tempfile


from quire.functions.decode import decode_bytes
from quire.operators.files import select_source_files
from quire.plans.prepare import tree_samples, tree_training_text
from quire.sources.tree import list_tree, read_contents, readable

KEPT = ["a.py", "a.PY", "..py", "a..py", "b.tar.Py", "a.markdown", "pkg/__init__.py", "_u.markdown", ".github/x.md", "a b%20c.py"]
DROPPED = [".py", "py", "a.py.", "x.md.txt", ".git/h.md"]


def make_tree(files):
    root = tempfile.mkdtemp(prefix="quire-tree-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(data)
    return root


def test_decode_bytes():
    assert decode_bytes(bytes.fromhex("78FF79EFBFBD7A")) == "xy�z"
    assert decode_bytes(b"\xff") == ""
    assert decode_bytes(b"a\r\nb\rc\n") == "a\nb\nc\n"
    assert decode_bytes("﻿x".encode()) == "﻿x"


def test_listing_and_filters(spark):
    files = {n: b"print(1)\n" for n in KEPT + DROPPED}
    files["empty.py"] = b""
    files["big.md"] = b"x" * 5000
    root = make_tree(files)
    listing = list_tree(spark, root, repo="r", num_partitions=3)
    # .git directories are not descended into by default
    assert sorted(r.path for r in listing.collect()) == sorted(f for f in files if not f.startswith(".git/"))
    full = spark.read.format("sourcetree").option("repo", "r").option("pruneVcs", "false").load(root)
    assert sorted(r.path for r in full.collect()) == sorted(files)
    assert {r.size for r in full.where("path = 'big.md' or path = 'empty.py'").collect()} == {0, 5000}
    listing = full
    kept = select_source_files(listing, 3000)
    assert sorted(r.path for r in kept.collect()) == sorted(KEPT)


def test_unreadable_files_are_counted_and_skipped(spark):
    root = make_tree({"a.py": b"x", "b.py": b"y", "c.py": b"z"})
    listing = select_source_files(list_tree(spark, root, repo="r"), 100).cache()
    listing.count()
    os.remove(os.path.join(root, "b.py"))  # vanishes between listing and reading
    files, obs = readable(read_contents(listing, root, 2))
    assert sorted(r.path for r in files.collect()) == ["a.py", "c.py"]
    assert obs.get["unreadable"] == 1
    listing.unpersist()


def test_tree_flow_and_early_stop(spark):
    body = ("line\n" * 3000).encode()  # 15000 chars → 2 pieces at 12,000
    root = make_tree({"b.py": body, "a.md": b"# t\n", "c/d.py": b"x = 1\n", ".git/x.py": b"no"})
    full = tree_training_text(spark, root, "owner/name", num_partitions=2)
    rows = sorted((r.path, r.chunk_idx, r.text) for r in full.collect())
    assert [(p, i) for p, i, _ in rows] == [("a.md", 1), ("b.py", 1), ("b.py", 2), ("c/d.py", 1)]
    assert rows[1][2].startswith("<|start|>user<|message|>Repository: owner/name\nFile: b.py (chunk 1/2)\n\n")
    first2 = tree_samples(spark, root, "owner/name", max_samples=2)
    assert [(r.path, r.chunk_idx) for r in first2.collect()] == [("a.md", 1), ("b.py", 1)]


def test_reader_cuts_batches_by_bytes():
    import pandas as pd

    from quire.sources.tree import _reader

    root = make_tree({f"f{i}.py": b"x" * 100 for i in range(10)})
    pdf = pd.DataFrame({"repo": ["r"] * 11, "path": [f"f{i}.py" for i in range(10)] + ["gone.py"], "size": [100] * 11})
    out = list(_reader(root, batch_bytes=250)(iter([pdf])))
    assert [len(b) for b in out] == [3, 3, 3, 2]
    merged = pd.concat(out)
    assert list(merged["path"]) == list(pdf["path"]) and merged["text"].isna().sum() == 1


def test_tree_flow_equals_table_flow(spark):
    """Documents written out as a tree give exactly the rows of the table-based flow."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from quire.plans.prepare import training_text
    from quire.sources import tables as TB

    from conftest import SF_SMALL

    t = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text", "source"]).to_pydict()
    exts = [".py", ".md", ".txt", ".PY"]
    root = make_tree({
        f"{src}/d{d % 7}/f{d}{exts[d % 4]}": txt.encode() for d, txt, src in zip(t["doc_id"], t["text"], t["source"])
    })
    docs = TB.read_table(spark, SF_SMALL, "documents")
    ext = F.element_at(F.array(*[F.lit(e) for e in exts]), (F.col("doc_id") % 4 + 1).cast("int"))
    files = docs.select(
        F.lit("t").alias("repo"),
        F.concat(F.col("source"), F.lit("/d"), (F.col("doc_id") % 7).cast("string"), F.lit("/f"),
                 F.col("doc_id").cast("string"), ext).alias("path"),
        F.octet_length("text").cast("bigint").alias("size"), "text")
    a = tree_training_text(spark, root, "t", max_chars=500)
    b = training_text(files, max_chars=500)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_uri_root_uses_arrow_filesystem(spark):
    files = {"a.py": b"x = 1\n", "pkg/__init__.py": b"", "docs/b.md": b"# b\n", ".git/c.py": b"no", "d.txt": b"t"}
    root = make_tree(files)
    uri = "file://" + root
    listing = list_tree(spark, uri, repo="r")
    assert sorted(r.path for r in listing.collect()) == sorted(f for f in files if not f.startswith(".git/"))
    got = sorted((r.path, r.chunk_idx) for r in tree_training_text(spark, uri, "r").collect())
    assert got == [("a.py", 1), ("docs/b.md", 1)]  # empty __init__.py and .txt are filtered


def _listed(monkeypatch, root, filters=(), **options):
    """What the pushing reader returns, the folders that were listed and the files that were looked at, over all its tasks."""
    from quire.sources import tree

    folders, looked = [], []

    class Fs(tree._LocalFs):
        def list(self, d, want=None):
            folders.append(os.path.relpath(d, root))
            for e in super().list(d, want):
                if e[1] == "f":
                    looked.append(os.path.relpath(os.path.join(d, e[0]), root))
                yield e

        def names(self, d):
            folders.append(os.path.relpath(d, root))
            return super().names(d)

    monkeypatch.setattr(tree, "_open", lambda r: (Fs(), os.path.abspath(r)))
    reader = tree.PushingReader({"path": root, "repo": "r", **options}, None)
    rest = list(reader.pushFilters(list(filters)))
    parts = reader.partitions()
    rows = [[r[1:] for r in reader.read(p)] for p in parts]
    return rest, rows, set(folders), looked


def test_pushed_filters_prune_the_walk(monkeypatch):
    import pyspark.sql.datasource as D

    root = make_tree({"src/a.py": b"12", "src/deep/b.py": b"1234", "src/c.txt": b"1", "other/x.py": b"1", "other/deep/y.py": b"1", "top.py": b"1", "srcs.py": b"1"})
    path, size = ("path",), ("size",)
    for budget in ("1", "64"):
        rest, rows, folders, looked = _listed(monkeypatch, root, [D.StringStartsWith(path, "src/"), D.StringEndsWith(path, ".py"), D.IsNotNull(path)], listingBudget=budget)
        assert rest == [] and sorted(sum(rows, [])) == [("src/a.py", 2), ("src/deep/b.py", 4)] and folders == {".", "src", "src/deep"}
        assert sorted(looked) == ["src/a.py", "src/deep/b.py"]
    other = D.StringContains(("repo",), "x")
    rest, rows, _, _ = _listed(monkeypatch, root, [D.GreaterThan(size, 1), D.LessThanOrEqual(size, 3), other])
    assert rest == [other] and sum(rows, []) == [("src/a.py", 2)]
    _, rows, folders, _ = _listed(monkeypatch, root, [D.EqualTo(path, "other/deep/y.py")])
    assert sum(rows, []) == [("other/deep/y.py", 1)] and folders == {".", "other", "other/deep"}
    _, rows, _, _ = _listed(monkeypatch, root, [], extensions=".PY,.md", maxBytes="2")
    assert sorted(p for p, _ in sum(rows, [])) == ["other/deep/y.py", "other/x.py", "src/a.py", "srcs.py", "top.py"]


def test_one_flat_folder_is_dealt_to_several_tasks(monkeypatch):
    root = make_tree({**{f"flat/f{i}.py": b"x" for i in range(1200)}, "flat/sub/g.py": b"x"})
    _, rows, _, looked = _listed(monkeypatch, root, folderFiles="100", numPartitions="4")
    assert sorted(p for p, _ in sum(rows, [])) == sorted([f"flat/f{i}.py" for i in range(1200)] + ["flat/sub/g.py"])
    assert len(looked) == 1201 and len(rows) >= 12 and max(map(len, rows)) < 200  # each file is looked at once, in its share's task


def test_filters_reach_the_listing_in_the_plan(spark):
    from pyspark.sql import functions as F

    root = make_tree({"src/a.py": b"12", "src/b.md": b"1", "other/x.py": b"1"})
    df = list_tree(spark, root, "r").where(F.col("path").startswith("src/") & (F.col("size") > 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "BatchScan sourcetree" in plan  # the source took both, none is left to Spark
    assert [tuple(r) for r in df.collect()] == [("r", "src/a.py", 2)]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:  # without the setting the same rows come from Spark's own filter
        df = list_tree(spark, root, "r").where(F.col("path").startswith("src/") & (F.col("size") > 1))
        assert "Filter (" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 1
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
