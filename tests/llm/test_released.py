"""Memory that Python workers hold between stages."""

from lakefold.llm import common


def test_objects_of_other_operators_go_and_freed_memory_is_given_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "_CACHE", {})
    monkeypatch.setattr(common, "give_back", lambda: given.append(True))
    common.in_memory_cache("mine", "a", lambda: 1)
    common.in_memory_cache("theirs", "b", lambda: 2)
    work = common.released(lambda batches: (b + 1 for b in batches), "mine")(iter([1, 2]))
    assert next(work) == 2 and [k for k, _ in common._CACHE] == ["mine"] and not given
    assert list(work) == [3] and given
    assert common.in_memory_cache("mine", "a", lambda: 3) == 1
