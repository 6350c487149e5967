"""Landed images lie in few folders and are read in lists of bounded length."""

from workload import queries


def landed(spark, tmp_path, monkeypatch, per_list):
    monkeypatch.setattr(queries, "FILES_PER_TASK", 10)
    monkeypatch.setattr(queries, "FOLDERS_PER_LIST", per_list)
    monkeypatch.setattr(queries.session, "shared_folder", lambda _, purpose: f"{tmp_path}/{purpose}-{per_list}")
    rows = [(i, "é" * (i % 7) if i % 5 else None) for i in range(60)]
    rows += [(7, "twice"), (8, "é"), (61, "line\nends\n")]
    spark.createDataFrame(rows, "page_id bigint, html string").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet")
    want = {}
    for i, html in rows:  # rows of one page share its file, a line end between them
        want[i] = want.get(i, -1) + (4 if i % 3 < 2 else 0) + len((html or "").encode()) + 1
    found = queries.image_objects(spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("page_id", "bigint"), ("n_bytes", "bigint"), ("kind", "string")]
    assert sorted(map(tuple, found.collect())) == [(i, n, ["jpeg", "png", None][i % 3]) for i, n in sorted(want.items())]
    return tmp_path / f"image-objects-{per_list}"


def test_a_task_lands_its_files_in_one_folder(spark, tmp_path, monkeypatch):
    out = landed(spark, tmp_path, monkeypatch, 200)
    assert sorted(f.name for f in out.iterdir()) == [f"part-{i:05d}" for i in range(7)]
    files = [f for f in out.rglob("*") if f.is_file()]
    # one a page, no checksums, nothing half written
    assert sorted(f.name for f in files) == sorted(f"page_id={i}.txt" for i in [*range(60), 61])
    assert not (tmp_path / "image-kinds-200").exists()


def test_files_are_listed_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    landed(spark, tmp_path, monkeypatch, 2)
    assert len(list((tmp_path / "image-kinds-2").glob("part-*.parquet"))) >= 4


def test_pages_in_a_store_of_another_kind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries.images, "own_path", lambda *_: None)
    out = landed(spark, tmp_path, monkeypatch, 200)
    assert (out / "page_id=7").is_dir()
