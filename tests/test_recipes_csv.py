"""The four reference recipes on small hand-written CSVs (schemas from FIXTURES.md)."""
import os

import pytest

from tabclass.plans import recipes
from tabclass.sources.catalog import REFERENCE_DATASETS, DatasetSpec, reference_registry
from tabclass.sources.files import read_csv


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(text.lstrip("\n"))
    return path


SOCIAL = """
age,gender,country,daily_usage_hours,primary_platform,num_platforms_used,purpose,avg_session_minutes,night_usage,mental_health_score,addiction_level,screen_time_before_sleep
21, Male ,India,5.5,TikTok,3,Fun,30.0,1,6.5,High,1.5
19,Female,  USA ,2.0,Instagram,2,Chat,12.5,0,7.1,Low,0.5
x20,Female,UK,3.0,Snap,1,Fun,20,1,5.0,Medium,1.0
22,Male,India,4.0,TikTok,4,Work,25,0,4.0,,2.0
23,Male,India,4.0,TikTok,4,Work,25,0,4.0,Unknown,2.0
24,Other,Brazil,7.25,YouTube,5,Fun,45,1,3.3, Medium ,3.0
"""


def test_social(spark, tmp_dir):
    df = read_csv(spark, _write(tmp_dir, "s.csv", SOCIAL), multi_line=True)
    out = recipes.normalize_social(df)
    rows = out.collect()
    assert out.columns[:3] == ["age", "num_platforms_used", "night_usage"]
    assert [r.addiction_level for r in rows] == ["High", "Low", "Medium", "Medium"]
    assert rows[0].gender == "Male" and rows[1].country == "USA"
    assert rows[2].age is None  # non-numeric age -> NULL, row kept
    assert dict(out.dtypes)["daily_usage_hours"] == "double" and dict(out.dtypes)["age"] == "int"


FRAUD = """
_c0,trans_date_trans_time,cc_num,merchant,category,amt,first,last,gender,street,city,state,zip,lat,long,city_pop,job,dob,trans_num,unix_time,merch_lat,merch_long,is_fraud
0,2019-01-06 13:05:00,1,m,grocery,10.5,A,B,F,s,c,NY,1,40.0,-73.0,1000,nurse,1990-12-31,t0,0,40.0,-73.0,0
1,2019-01-07 23:59:59,1,m,travel,99.0,A,B,M,s,c,CA,1,0.0,0.0,200,chef,1980-01-01,t1,0,0.0,180.0,1
2,2019-01-08 00:00:00,1,m,travel,,A,B,M,s,c,CA,1,0.0,0.0,200,chef,1980-01-01,t2,0,0.0,10.0,0
3,2019-01-08 00:00:00,1,m,travel,5.0,A,B,M,s,c,CA,1,0.0,0.0,200,chef,1980-01-01,t3,0,0.0,10.0,
4,not a date,1,m,travel,5.0,A,B,M,s,c,CA,1,0.0,0.0,200,chef,1980-01-01,t4,0,0.0,10.0,0
5,2019-03-01 08:00:00,1,m,food,7.0,A,B,F,s,c,,1,0.0,0.0,200,chef,1980-06-01,t5,0,1.0,1.0,0
"""


def test_fraud(spark, tmp_dir):
    df = read_csv(spark, _write(tmp_dir, "f.csv", FRAUD), multi_line=True)
    out = recipes.normalize_fraud(df)
    assert out.columns == [c for c, _ in recipes.FRAUD_CONTRACT]
    rows = sorted(out.collect(), key=lambda r: r.amt)
    assert len(rows) == 2  # NULL amt, NULL target, bad date and NULL state dropped
    a, b = rows
    assert (a.trans_hour, a.trans_day_of_week, a.age, a.distance_to_merchant) == (13, 1, 29, 0.0)
    assert (b.trans_hour, b.trans_day_of_week, b.age) == (23, 2, 39)
    assert abs(b.distance_to_merchant - 3.141592653589793 * 6371.0) < 1e-6  # antipodal, no NaN


MATCHES = """
game_id,champion_name,team_position,total_damage_dealt,kills,final_armor,win,lane
1, Ahri ,MID,123456789012,5,30.5,1,x
2,Garen,TOP,1000,2.7,20,0,x
3,Lux,SUP,10,1,abc,,x
4,Lux,SUP,10,1,1,NULL,x
5,Lux,SUP,10,1,1,True,x
6,Lux,SUP,10,1,1, 1 ,x
"""


def test_matches_small_lists(spark, tmp_dir):
    df = read_csv(spark, _write(tmp_dir, "m.csv", MATCHES), multi_line=True)
    cols = recipes.MatchesColumns(
        drop=("game_id", "lane", "not_there"),
        strings=("champion_name", "team_position"),
        longs=("total_damage_dealt",),
        ints=("kills",),
        doubles=("final_armor",),
    )
    out = recipes.normalize_matches(df, cols)
    rows = out.collect()
    assert out.columns == ["champion_name", "team_position", "total_damage_dealt", "kills", "final_armor", "win"]
    assert [r.win for r in rows] == ["1", "0", "0", "0", "1"]  # 'True' filtered out
    assert rows[0].champion_name == "Ahri" and rows[0].total_damage_dealt == 123456789012
    assert rows[1].kills == 2 and rows[2].final_armor is None
    drop = recipes.normalize_matches(df, recipes.MatchesColumns(**{**cols.__dict__, "missing_target": "drop"}))
    assert [r.win for r in drop.collect()] == ["1", "0", "1"]


def test_matches_reference_lists_counts():
    cols = recipes.lol_matches_columns()
    assert len(cols.drop) == 36
    kept = len(cols.strings) + len(cols.longs) + len(cols.ints) + len(cols.doubles) + 1
    assert kept == 58


SALARY = """
job_title,experience_years,education_level,skills_count,industry,company_size,location,remote_work,certifications,salary
 Dev ,3,BSc,5,IT,Large,Paris,Yes,1,100
Dev,4.5,MSc,6,IT,Large,Paris,No,0,200
Ops,1,BSc,2,IT,Small,Rome,No,2,200
Ops,2,BSc,3,Retail,Small,Rome,Yes,0,300
QA,2,PhD,3,Retail,Small,Oslo,No,1,400
QA,5,PhD,9,Retail,Mid,Oslo,No,1,
"""


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_salary(spark, tmp_dir, method):
    df = read_csv(spark, _write(tmp_dir, f"j_{method}.csv", SALARY), multi_line=True)
    out = recipes.normalize_salary(df, recipes.SalaryColumns(quantile_method=method))
    assert "salary" not in out.columns and out.columns[-1] == "salary_category"
    got = [(r.job_title, r.salary_category) for r in out.collect()]
    # cut points 200 / 300 (ties at 200 stay Low); NULL salary dropped
    assert got == [("Dev", "Low"), ("Dev", "Low"), ("Ops", "Low"), ("Ops", "Medium"), ("QA", "High")]
    assert out.collect()[1].experience_years == 4


def test_catalog_and_registry(spark):
    reg = reference_registry()
    assert reg.names() == ["gen_z_social", "fraud_detection", "lol_matches", "job_salary"]
    with pytest.raises(KeyError):
        reg.get("nope")
    with pytest.raises(ValueError):
        DatasetSpec("x", "p", "t", "huge")
    rows = reg.frame(spark).orderBy("position").collect()
    assert rows[1].target_column == "is_fraud" and rows[3].size_category == "medium"


def test_spec_run_on_csv(spark, tmp_dir):
    path = _write(tmp_dir, "s2.csv", SOCIAL)
    spec = DatasetSpec("gen_z_social", path, "addiction_level", "medium", normalize=recipes.normalize_social)
    assert spec.run(spark).count() == 4
    assert REFERENCE_DATASETS[0].path.endswith("genz_social_media_usage_1M.csv")


def test_text_schema_matches_inferred_results(spark, tmp_dir):
    """Reading every column as text (no inference pass) gives the same
    normalised rows as the reference's inferSchema read."""
    from tabclass.sources.files import header_text_schema

    for name, text, norm in [
        ("s3.csv", SOCIAL, recipes.normalize_social),
        ("f3.csv", FRAUD, recipes.normalize_fraud),
        ("j3.csv", SALARY, lambda d: recipes.normalize_salary(d, recipes.SalaryColumns(quantile_method="exact"))),
    ]:
        path = _write(tmp_dir, name, text)
        inferred = norm(read_csv(spark, path, multi_line=True))
        textual = norm(read_csv(spark, path, schema=header_text_schema(spark, path), multi_line=True))
        assert inferred.dtypes == textual.dtypes
        assert sorted(map(tuple, inferred.collect()), key=str) == sorted(map(tuple, textual.collect()), key=str)


def test_registry_exact_terciles(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "data/raw/job_salary"), exist_ok=True)
    _write(tmp_dir, "data/raw/job_salary/job_salary_prediction_dataset.csv", SALARY)
    spec = reference_registry(exact_quantiles=True).get("job_salary")
    got = sorted((r.job_title, r.experience_years, r.salary_category) for r in spec.run(spark, tmp_dir).collect())
    assert got == [("Dev", 3, "Low"), ("Dev", 4, "Low"), ("Ops", 1, "Low"), ("Ops", 2, "Medium"), ("QA", 2, "High")]
