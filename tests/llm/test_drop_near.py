"""One document of each group, whatever its ids."""

from firmweave.llm import near_dedup


def test_one_row_of_each_group_stays(docs):
    same, other = "a b c d e f", "u v w x y z"
    rows = [(None, same), (None, same), (7, same), (7, same), (9, same), (None, other), (None, other), (7, "k l m n o p"), (3, None), (None, ""), (None, "")]
    left = near_dedup.drop_near_duplicates(docs(rows))
    assert left.columns == docs([]).columns
    expected = [(None, other), (7, same), (7, "k l m n o p"), (3, None), (None, ""), (None, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(expected, key=repr)
