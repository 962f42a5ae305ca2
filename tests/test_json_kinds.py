import json

import pytest

from quire.sources.tables import open_table

TURN = {"conversations": [{"from": "human", "value": "hi"}]}


def lines(folder, rows):
    path = str(folder / "rows.jsonl")
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return path


def test_kind_id_and_split_are_told_from_all_rows(spark, tmp_path):
    path = lines(tmp_path, [{"conversations": None}, {**TURN, "split": "test"}, {**TURN, "id": "a", "split": "train"}])
    df = open_table(spark, path)
    assert df.columns == ["id", "split", "conversations"]
    assert [(r["id"], r["split"], r["conversations"] is None) for r in df.collect()] == [(None, None, True), (None, "test", False), ("a", "train", False)]


def test_rows_of_two_kinds_are_an_error(spark, tmp_path):
    path = lines(tmp_path, [TURN, {"messages": [{"role": "user", "content": "hi"}]}])
    with pytest.raises(ValueError, match="more than one kind"):
        open_table(spark, path)


def test_no_rows_are_messages(spark, tmp_path):
    assert open_table(spark, lines(tmp_path, [])).columns == ["messages"]
