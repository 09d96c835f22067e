"""Raw project records as JSON, in the shapes the source API uses, built by Spark from the stand-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.sources.durable import tidy
from checks.fixtures import fixture


def _json(**fields: Column) -> Column:
    """A JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def _variant(**fields: Column) -> Column:
    return F.parse_json(_json(**fields))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, id, status, rec, related, detail) of every project; detail and related exist for some."""
    projects = fixture(spark, sf_dir, "fx_projects")
    members = (
        fixture(spark, sf_dir, "fx_members")
        .groupBy("k")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "s")))["s"].alias("team"))
    )
    k = F.col("k")
    team = F.coalesce("team", F.array().cast("array<bigint>"))
    as_objects = F.transform(
        team,
        lambda s: F.struct(
            s.alias("user_id"), F.when(s % 4 == 0, F.concat(F.lit("Lead "), s.cast("string"))).alias("full_name")
        ),
    )
    # Custom fields come as an object, as a list of field objects, or as an empty list.
    as_object = _variant(
        c_projecttype=F.col("project_type"), c_clientcountry=F.col("client_country"),
        c_businessarea=F.array(F.lit("Brand"), F.lit(""), F.col("tags")),
    )
    as_list = F.parse_json(
        F.to_json(
            F.array(
                *[
                    F.struct(name.alias("name"), code.alias("code"), value.alias("value"))
                    for name, code, value in (
                        (F.lit("c_projecttype"), F.lit("x"), F.lit("old")),
                        (F.lit("c_projecttype"), F.lit("y"), F.col("project_type")),
                        (F.lit(None).cast("string"), F.lit("c_ponumber"), F.concat(F.lit("PO-"), F.col("scoro_id"))),
                    )
                ]
            )
        )
    )
    custom = F.when(k % 3 == 0, as_object).when(k % 3 == 1, as_list).otherwise(F.parse_json(F.lit("[]")))
    rec = _variant(
        project_id=k,
        no=F.col("project_no"),
        project_name=F.col("project_name"),
        status=F.col("status"),
        managerId=F.when(k % 4 != 0, F.col("custkey") % 120 + 1),
        manager_email=F.when(k % 8 != 1, F.concat(F.lit("m"), F.col("custkey").cast("string"), F.lit("@example.com"))),
        date=F.concat(F.col("start_date").cast("string"), F.lit("T08:00:00")),
        deadline=F.col("due_date").cast("string"),
        description=F.col("description"),
        company_id=F.when(k % 5 != 2, F.col("custkey")),
        company_name=F.when(k % 5 == 3, F.concat(F.lit(" "), F.col("client_company"))),
        customFields=custom,
        c_clientcountry=F.when(k % 3 == 2, F.col("client_country")),
        project_users=F.when(k % 2 == 0, as_objects),
        members=F.when(k % 2 == 1, team),
        tags=F.when(k % 7 == 0, F.to_variant_object(F.array(F.col("tags"), F.lit(""), F.lit("extra")))).otherwise(
            F.col("tags").cast("variant")
        ),
        open=F.lit(False),
        hours=F.lit(0),
    )
    related = F.when(
        k % 3 == 1,
        _variant(
            users=F.struct(
                F.array(
                    F.struct(F.lit("Rel").alias("firstname"), F.col("client_country").alias("lastname")),
                    F.struct(F.lit("").alias("firstname"), F.lit("").alias("lastname")),
                ).alias("items")
            ),
            companies=F.array(
                F.struct(F.concat(F.lit("Holding "), F.col("client_country")).alias("name")),
                F.struct(F.concat(F.lit("Partner "), F.col("tags")).alias("name")),
            ),
            contacts=F.array(
                F.struct(
                    F.lit("person").alias("contact_type"), F.lit("Ann").alias("name"),
                    F.col("client_country").alias("lastname"), F.lit("Buyer").alias("position"),
                ),
            ),
        ),
    )
    detail = F.when(
        k % 2 == 0,
        _variant(
            project_id=k,
            description=F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("From the detail record")),
            company_name=F.when(k % 6 == 0, F.concat(F.lit("Detail "), F.col("client_country"))).otherwise(F.lit("")),
            members=F.array().cast("array<bigint>"),
            open=F.lit(True),
            hours=F.lit(0),
            customFields=F.struct(F.lit("detail type").alias("c_projecttype"), F.lit("low").alias("c_project_priority")),
        ),
    )
    # The given files are one small file each; spread the rows as landed files would be.
    return projects.join(members, "k", "left").repartition("k").select(
        "k", F.col("scoro_id").alias("id"), "status", rec.alias("rec"), related.alias("related"), detail.alias("detail")
    )


def landed_pages(spark: SparkSession, sf_dir: str, place: str, files: int | None = None) -> None:
    """Write the records as the list call gives them: one JSON line per status and page of keys.

    They are packed, in as many files as there are tasks; with `files` they are plain lines in so many files.
    """
    rows = records(spark, sf_dir).filter("status is not null").select(
        "status", F.floor(F.col("k") / 100).alias("page"), "k", F.to_json("rec").alias("json")
    )
    pages = rows.groupBy("status", "page").agg(F.array_sort(F.collect_list(F.struct("k", "json")))["json"].alias("data"))
    line = F.concat(
        F.lit('{"status":"'), F.col("status"), F.lit('","page":'), F.col("page").cast("string"),
        F.lit(',"data":['), F.array_join("data", ","), F.lit("]}"),
    )
    with tidy(spark):
        if files is None:
            pages.select(line.alias("value")).write.option("compression", "gzip").text(place)
        else:
            pages.select(line.alias("value")).repartition(files, "page").write.text(place)
