"""Waiting for the file of one month."""

import datetime

import simmart as sm

MARCH = datetime.date(2024, 3, 1)


class Clock:
    """Time that passes only in ``sleep``; a file appears at its hour."""

    def __init__(self, at=None, appears=None):
        self.now, self.naps, self.at, self.appears = 0.0, [], at, appears

    def sleep(self, seconds):
        self.naps.append(seconds)
        self.now += seconds
        if self.at is not None and self.now >= self.at:
            self.appears()

    def wait(self, spark, folder, **kwargs):
        return sm.await_month(spark, folder, MARCH, clock=lambda: self.now, sleep=self.sleep, **kwargs)


def test_gives_up_at_the_deadline(spark, folder):
    clock = Clock()
    got = clock.wait(spark, f"{folder}/not/there")
    assert got.gave_up and got.waited == 18 * 3600 and clock.naps == [3600.0] * 18
    clock = Clock()
    assert clock.wait(spark, folder, timeout=100, poll=40).gave_up and clock.naps == [40, 40, 20]


def test_finds_a_file_that_comes_late_and_no_other(spark, folder):
    for name in ("data_02_2024.csv", "data_03_2023.csv", "data_03_2024.txt"):
        open(f"{folder}/{name}", "w").write("molecule name,smiles\nCHEMBL1,C\n")

    def arrive():
        open(f"{folder}/data_03_2024.csv", "w").write("molecule name,smiles\nCHEMBL2,CC\n")

    clock = Clock(7200, arrive)
    got = clock.wait(spark, folder)
    assert got.path.endswith("/data_03_2024.csv") and got.waited == 7200
    _, targets, rejects = sm.month_targets(spark, folder, MARCH)
    assert [tuple(r) for r in targets.collect()] == [("CHEMBL2", "CC")] and rejects.count() == 0


def test_empty_file_is_rejected_by_its_name(spark, folder):
    open(f"{folder}/data_03_2024.csv", "w").close()
    got, targets, rejects = sm.month_targets(spark, folder, MARCH)
    assert targets.count() == 0 and [r.reject_reason for r in rejects.collect()] == ["empty_file"]
    assert rejects.collect()[0].line.endswith("/data_03_2024.csv")


def test_unfinished_folder_is_waited_for(spark, folder):
    path = f"{folder}/data_03_2024.csv"
    spark.createDataFrame([("CHEMBL1", "C")], "`molecule name` string, smiles string").write.option("header", True).csv(f"{path}/_temporary")
    assert Clock().wait(spark, folder, timeout=1).gave_up
    spark.createDataFrame([("CHEMBL1", "C")], "`molecule name` string, smiles string").write.option("header", True).mode("overwrite").csv(path)
    assert Clock().wait(spark, folder, timeout=1).path.endswith("data_03_2024.csv")
