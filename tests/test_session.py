import zipfile

from postloom import session
from postloom.session import package_archive, ship_packages


def test_archives_are_named_by_content(tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    one, two = package_archive("catalog", tmp_path / "a"), package_archive("catalog", tmp_path / "b")
    assert one.name == two.name and one.read_bytes() == two.read_bytes()
    assert "catalog/registry.py" in zipfile.ZipFile(one).namelist()


def test_packages_are_shipped_once_in_any_combination(spark, monkeypatch):
    monkeypatch.setattr(session, "_SHIPPED", set())
    for names in (("postloom", "catalog"), ("postloom",), ("catalog", "postloom")):
        ship_packages(spark, *names)
        assert spark.range(10).selectExpr("sum(id) AS s").first()["s"] == 45
    assert len(session._SHIPPED) == 2
