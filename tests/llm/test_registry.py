import __spark_entry__ as entry


def test_every_operator_has_its_query():
    names = entry.queries().keys()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
