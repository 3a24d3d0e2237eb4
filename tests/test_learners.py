"""Library learners fit as far as the library lets them."""

from minewright.operators import learners


def test_tree_fits_a_label_deeper_than_five_splits(spark):
    rows = spark.createDataFrame([("x", float(k % 24), str(k % 2)) for k in range(96)], "kind STRING, number DOUBLE, label STRING")
    model = learners.tree_pipeline(["kind"], ["number"]).fit(rows)
    assert model.transform(rows).where("prediction <> label_i").count() == 0


def test_kernel_machine_may_take_the_library_rounds(spark, monkeypatch):
    made, real = [], learners.LinearSVC
    monkeypatch.setattr(learners, "LinearSVC", lambda **options: made.append(options) or real(**options))
    rows = spark.createDataFrame([([k / 10, (k * 7 % 10) / 10], int(k % 3 == 0)) for k in range(30)], "data ARRAY<DOUBLE>, match INT")
    learners.kernel_machine(rows, 2, size=4)
    assert made[0]["maxIter"] >= 100


def test_kernel_machine_fits_equal_rows_once_by_their_weight(spark, monkeypatch):
    seen = []
    real = learners.LinearSVC.fit
    monkeypatch.setattr(learners.LinearSVC, "fit", lambda self, rows: seen.append(rows.count()) or real(self, rows))
    few = [([k / 10, (k * 7 % 10) / 10], int(k % 10 >= 5)) for k in range(10)]
    asked = spark.createDataFrame(few, "data ARRAY<DOUBLE>, match INT")
    many = asked.unionByName(asked).unionByName(asked)
    guesses = [learners.kernel_machine(rows, 2, size=4)(asked).orderBy("data").select("data", "prediction").collect() for rows in (asked, many)]
    assert seen == [10, 10]
    assert guesses[0] == guesses[1]
