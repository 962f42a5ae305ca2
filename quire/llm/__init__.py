"""Operations of a training-data pipeline over large text corpora.

Nothing outside this subpackage imports it. Each module is one operator with its
own interface; ``queries`` holds the thin registered queries over the test tables.
"""
