"""Layouts of the dumps on literal rows: missing values, ties, several rows of a key, extra columns."""

from __future__ import annotations

from assayframe.plans import layouts


def test_oregon(rows):
    raw = rows([("l", "p", "s", "3", "2021", "Buds", "THC", None, 1), ("l", "p", "s", "3", "2021", "Buds", "THC", 5.0, 2), ("l", "p", "s", "3", "2021", "Buds", "THC", 6.0, 3), ("l", "p", "s", "x", "2021", "Buds", "THC", 7.0, 4), ("l", None, "s", "3", "2021", "Buds", "THC", 8.0, 5)], "LabId string, SampleCreatedByLicenseId string, SampleId string, MonthOfTest string, YearOfTest string, ProductType string, TestName string, Result double, at int")
    assert [(r.sample_id, r.month, r.year, r.THC, r.CBD) for r in layouts.oregon(raw, ["THC", "CBD"], ["at"]).collect()] == [("s", "2021-03", 2021, 5.0, None)]


def test_maryland(rows):
    schema = "TestPerformedDate string, PackageId string, StrainName string, TestingFacilityId string, ProductCategoryName string, TestTypeName string, TestResultLevel double, TestPassed boolean, at int, other string"
    raw = rows([("2", "a", "x", "l", "Buds", "THC (%) Infused Edible", 1.0, None, 1, "o"), ("1", "a", "x", "l", "Buds", "THC (%) Raw Plant Material", 2.0, True, 2, "o"), ("1", "b", "x", "l", "Buds", "THC (%) Infused Edible", 3.0, False, 3, "o")], schema)
    tests = ["THC (%) Raw Plant Material", "THC (%) Infused Edible"]
    assert sorted((r.package_id, r.date_tested, r.thc, r.status) for r in layouts.maryland(raw, tests, ["at"]).collect()) == [("a", "1", 2.0, "Pass"), ("b", "1", 3.0, "Fail")]
    assert layouts.maryland(raw.where("false"), tests, ["at"]).count() == 0


def test_mississippi(rows):
    schema = "`Testing Facility UID` string, ResultRecordedDateTime string, `Package ID` string, Quantity double, Name string, Note string, at int"
    raw = rows([("l", "2024-01-02", "p", 1.0, "THC (%) Raw Buds", "b", 1), ("l", "2024-01-03", "p", 2.0, "CBD (%) Raw Buds", "a", 2), ("l", "2024-01-01", "p", 3.0, "CBD (%) Raw Buds", "b", 3), ("l", "2024-01-01", "q", 3.0, "CBD (%) Raw Buds", None, 4)], schema)
    got = sorted((r.product_id, r.product_type, r.THC, r.CBD, r.date_tested, r.notes) for r in layouts.mississippi(raw, ["THC", "CBD"], ["at"]).collect())
    assert got == [("p", "Raw Buds", 1.0, 2.0, "2024-01-03", "b, a"), ("q", "Raw Buds", None, 3.0, "2024-01-01", "")]


def test_new_jersey(rows):
    schema = "TestPerformedDate string, METRCTag string, TestTypeName string, TestTypeNamePart string, TestPassed boolean, TestResultLevel double, TestingFacilityId string, at int"
    tag = "1A4050300001234567"
    raw = rows([("2023-03-01", tag, "THC (%) Raw Plant Material", "THC", None, 1.0, "l", 1), ("2023-03-01", tag, "THC (%) R&D Testing", "THC", True, 2.0, "l", 2), ("2023-03-01", tag, "THC (%) Unknown", "THC", True, 3.0, "l", 3), ("2025-03-01", "t", "THC (%) Edibles", "THC", False, 4.0, "l", 4)], schema)
    wide = layouts.new_jersey(raw, ["THC"], ["at"])
    assert sorted((r.label, r.product_type, r.THC, r.status, r.r_and_d) for r in wide.collect()) == [(tag, "R&D Testing", 2.0, "Pass", True), (tag, "Raw Plant Material", 1.0, "Pass", True), (tag, "Unknown", 3.0, "Pass", True), ("t", "Edibles", 4.0, "Fail", False)]
    assert sorted(((r.product_type or "", r.producer_id, r.month) for r in layouts.new_jersey_sample(wide).collect())) == [("", tag[12:15], "2023-03"), ("Flower", tag[12:15], "2023-03")]
