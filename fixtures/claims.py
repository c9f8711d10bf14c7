"""Raw claims tables derived from the TPC-H-like star tables, defects included (FIXTURES.md).

Amounts are computed in whole cents, so any engine gets the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.sources.schemas import RAW_COLUMNS

TIER_OF_REMAINDER = ("Gold", "Platinum", "Bronze", "Silver")


def pick(index: Column, values) -> Column:
    """values[index] as a short CASE."""
    out = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(index == i, F.lit(v))
    return out


def code(prefix: str, n: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def money_text(c: Column) -> Column:
    whole, rest = F.abs(c) / 100, F.abs(c) % 100
    sign = F.when(c < 0, "-").otherwise("")
    return F.concat(sign, F.floor(whole).cast("string"), F.lit("."), F.lpad(rest.cast("string"), 2, "0"))


def day(text: str, plus: Column | int = 0) -> Column:
    p = F.lit(plus) if isinstance(plus, int) else plus
    return F.date_add(F.lit(text).cast("date"), p.cast("int"))


def iso(d: Column) -> Column:
    return F.coalesce(d.cast("string"), F.lit(""))


def slashed(d: Column, sep: str) -> Column:
    s = d.cast("string")
    return F.concat(s.substr(9, 2), F.lit(sep), s.substr(6, 2), F.lit(sep), s.substr(1, 4))


def odd_city(city: Column, key: Column, every: int) -> Column:
    """City-casing defect: lower case with a trailing space, or upper case."""
    return (
        F.when(key % (2 * every) == 0, F.concat(F.lower(city), F.lit(" ")))
        .when(key % (2 * every) == every, F.upper(city))
        .otherwise(city)
    )


def idiv(a: Column, b: int) -> Column:
    return F.floor(a / b) if b != 1 else a


def tier_rank(policy_no: Column) -> Column:
    """0 for Bronze to 3 for Platinum; what a plan grants rises in a straight line with it."""
    return (policy_no + 2) % 4


class StarSource:
    """The eight raw tables as lazy DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def star(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)().select(*[F.col(c).cast("string") for c in RAW_COLUMNS[name]])

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in RAW_COLUMNS}

    # -- books and parties -------------------------------------------------
    def _nation_city(self) -> DataFrame:
        n = self.star("nation")
        city = F.concat(F.upper(F.substring("n_name", 1, 1)), F.lower(F.substring("n_name", 2, 1000)))
        return n.select("n_nationkey", "n_name", "n_regionkey", city.alias("nation_city"))

    def employer_groups(self) -> DataFrame:
        k = F.col("n_nationkey")
        lives = 120 + 97 * k
        g = self._nation_city().join(self.star("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return g.select(
            code("EG", k + 1, 4).alias("group_id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("industry"),
            odd_city(F.col("nation_city"), k, 5).alias("city"),
            F.lit("2024-01-01").alias("contract_start"),
            F.lit("2027-01-01").alias("contract_end"),
            lives.alias("lives_covered"),
            money_text(lives.cast("bigint") * 250000).alias("monthly_premium_pkr"),
        )

    def policies(self) -> DataFrame:
        """The policies some customer holds (sixty once there are sixty customers)."""
        i = F.col("i")
        held = self.star("customer").select((F.col("c_custkey") % 60 + 1).alias("i")).distinct()
        tier, rank = pick(i % 4, TIER_OF_REMAINDER), tier_rank(i)
        return held.select(
            code("POL", i, 4).alias("policy_id"),
            F.concat(tier, F.lit(" Plan "), i.cast("string")).alias("plan_name"),
            tier.alias("plan_tier"),
            ((rank + 1) * 450_000).alias("annual_limit_pkr"),
            ((rank + 1) * 8_500).alias("room_rent_cap_pkr"),
            (4_200 - rank * 1_100).alias("deductible_pkr"),
            F.concat(F.lit("0."), F.lpad((23 - rank * 6).cast("string"), 2, "0")).alias("copay_pct"),
            F.when(tier == "Bronze", "False").otherwise("True").alias("maternity_covered"),
            (10 - rank * 2).alias("pre_existing_waiting_months"),
        )

    def providers(self) -> DataFrame:
        k = F.col("s_suppkey")
        s = self.star("supplier").join(self._nation_city(), F.col("s_nationkey") == F.col("n_nationkey"))
        return s.select(
            code("PR", k, 9).alias("provider_id"),
            F.col("s_name").alias("hospital_name"),
            odd_city(F.col("nation_city"), k, 10).alias("city"),
            pick(k % 4, ["Hospital", "Clinic", "Diagnostic", "Pharmacy"]).alias("provider_type"),
            F.when(k % 10 < 7, "In-Network").otherwise("Out-of-Network").alias("network_status"),
            pick(k % 3, ["A", "B", "C"]).alias("tier"),
            iso(day("2024-07-01", -((k * 37) % 1825))).alias("panel_since"),
        )

    def members(self) -> DataFrame:
        k = F.col("c_custkey")
        c = self.star("customer").join(self._nation_city(), F.col("c_nationkey") == F.col("n_nationkey"))
        enrolled = day("2024-06-30", -((k * 13) % 730))
        born = (
            F.when(k % 250 == 1, F.lit("2027-01-01"))
            .when(k % 250 == 2, F.lit("1890-01-01"))
            .otherwise(iso(day("2026-06-30", -((k * 7919) % 25000))))
        )
        return c.select(
            code("MB", k, 9).alias("member_id"),
            F.concat(F.lpad((k % 100000).cast("string"), 5, "0"), F.lit("-*******-"), (k % 10).cast("string"))
            .alias("masked_cnic"),
            F.col("c_name").alias("name"),
            pick(k % 2, ["Male", "Female"]).alias("gender"),
            born.alias("date_of_birth"),
            odd_city(F.col("nation_city"), k, 20).alias("city"),
            code("EG", F.col("n_nationkey") + 1, 4).alias("employer_group_id"),
            code("POL", k % 60 + 1, 4).alias("policy_id"),
            F.when(k % 2 == 1, slashed(enrolled, "-")).otherwise(iso(enrolled)).alias("enrolment_date"),
            F.when(k % 25 == 3, "2026-01-31").otherwise("").alias("termination_date"),
            pick(k % 3, ["Self", "Spouse", "Child"]).alias("relationship"),
        )

    def diagnoses(self) -> DataFrame:
        """The codes some order leads to (all twenty-six on any real volume)."""
        i = F.col("i")
        used = self.star("orders").select(((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 26).alias("i")).distinct()
        return used.select(
            code("DX", i, 2).alias("diagnosis_code"),
            F.concat(F.lit("Diagnosis "), i.cast("string")).alias("description"),
            F.concat(F.lit("Chapter "), (i % 13).cast("string")).alias("chapter"),
        )

    def procedures(self) -> DataFrame:
        return self.star("part").select(
            F.concat(F.lit("PX"), F.col("p_partkey").cast("string")).alias("procedure_code"),
            F.col("p_name").alias("description"),
            F.col("p_type").alias("category"),
            money_text(cents(F.col("p_retailprice"))).alias("typical_cost_pkr"),
        )

    # -- claims ------------------------------------------------------------
    @staticmethod
    def _with_terms(orders: DataFrame) -> DataFrame:
        """Status, plan numbers and approved share (in parts of 10,000) of each order."""
        k, o = F.col("o_orderkey"), F.col("o_orderstatus")
        policy_no = F.col("o_custkey") % 60 + 1
        status = (
            F.when(o == "F", "Paid")
            .when(o == "P", F.when(k % 2 == 0, "Partially Paid").otherwise("Denied"))
            .when(k % 4 == 0, "Pending")
            .when(k % 4 == 1, "In Review")
            .otherwise("Paid")
        )
        whole = 6_900 + tier_rank(policy_no) * 650
        share = F.when(status == "Partially Paid", idiv(whole, 2)).when(~status.isin("Denied", "Pending"), whole).otherwise(0)
        return orders.withColumns({"policy_no": policy_no, "status": status, "share": share.cast("bigint")})

    def _clean_headers(self) -> DataFrame:
        k = F.col("o_orderkey")
        suppliers = self.star("supplier").agg(F.count(F.lit(1)).alias("n"))
        orders = self._with_terms(self.star("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
        kind = pick(k % 7, ["Inpatient", "Outpatient", "Daycare", "Pharmacy", "Diagnostic", "Maternity", "Emergency"])
        stays = kind.isin("Inpatient", "Maternity", "Emergency")
        mode = F.when(k % 20 < 11, "Auto").otherwise("Manual")
        base = orders.withColumns({
            "pk": (k * 31 + F.col("o_custkey")) % suppliers.scalar(),
            "claim_type": kind,
            "adjudication_mode": mode,
            "admitted": day("2024-07-01", F.pmod(F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")), F.lit(730))),
        })
        base = base.withColumn("discharged", F.date_add("admitted", F.when(stays, 2 + k * 3 % 8).otherwise(0).cast("int")))
        base = base.withColumn("submitted", F.date_add("discharged", (k * 5 % 17).cast("int")))
        base = base.withColumn("adjudicated", F.when(
            F.col("status") != "Pending",
            F.date_add("submitted", F.when(mode == "Auto", k * 3 % 5).otherwise(11 + k * 7 % 26).cast("int"))))
        base = base.withColumn("paid_on", F.when(
            F.col("status").isin("Paid", "Partially Paid"), F.date_add("adjudicated", (3 + k * 11 % 23).cast("int"))))
        base = base.withColumn("billed", cents(F.col("o_totalprice")) * F.when(F.col("pk") % 40 == 7, 3).otherwise(1))
        base = base.withColumn("approved", idiv(F.col("billed") * F.col("share"), 10000))
        # The member pays the deductible or the copay, whichever is more.
        rank, approved = tier_rank(F.col("policy_no")), F.col("approved")
        floor, copay = (420_000 - rank * 110_000).cast("bigint"), idiv(approved * (23 - rank * 6), 100)
        base = base.withColumn("member_share", F.least(approved, F.greatest(floor, copay)))
        return base.withColumn("paid", F.when(F.col("status").isin("In Review", "Pending", "Denied"), F.lit(0).cast("bigint"))
                               .otherwise(F.col("approved") - F.col("member_share")))

    def claims_header(self) -> DataFrame:
        """One claim per order, with each defect in its own block of ``o_orderkey % 1000``."""
        k = F.col("o_orderkey")
        b = k % 1000
        billed, amount_defect = F.col("billed"), b.between(400, 405)
        discharged = F.when(b.between(300, 307), F.date_add("admitted", (-(1 + k % 4)).cast("int"))).otherwise(
            F.col("discharged"))
        rows = self._clean_headers().select(
            code("CLM", k, 10).alias("claim_id"),
            F.when(b.between(200, 202), "MB999999").otherwise(code("MB", F.col("o_custkey"), 9)).alias("member_id"),
            F.when(b.between(203, 204), "PR9999").otherwise(code("PR", F.col("pk"), 9)).alias("provider_id"),
            code("POL", F.col("policy_no"), 4).alias("policy_id"),
            "claim_type",
            iso(F.col("admitted")).alias("admission_date"),
            iso(discharged).alias("discharge_date"),
            F.when(k % 2 == 1, slashed(F.col("submitted"), "/")).otherwise(iso(F.col("submitted"))).alias("submission_date"),
            iso(F.col("adjudicated")).alias("adjudication_date"),
            iso(F.col("paid_on")).alias("payment_date"),
            "status",
            F.when(F.col("status") == "Denied", code("DR", k % 10 + 1, 2)).otherwise("").alias("denial_reason_code"),
            money_text(F.when(b.between(500, 502), -(1 + k % 5000) * 100).otherwise(billed)).alias("billed_amount_pkr"),
            money_text(F.when(amount_defect, idiv(billed * 12, 10)).otherwise(F.col("approved"))).alias("approved_amount_pkr"),
            money_text(F.when(amount_defect, idiv(billed * 13, 10)).otherwise(F.col("paid"))).alias("paid_amount_pkr"),
            money_text(F.col("member_share")).alias("member_share_pkr"),
            F.when(b.between(100, 114), "").otherwise(F.col("adjudication_mode")).alias("adjudication_mode"),
            k.alias("order_no"),
        )
        # The second copy of a duplicated claim comes from the same row, so the source is read once.
        ids = F.when(F.col("order_no") % 1000 < 20,
                     F.array(F.col("claim_id"), code("CLMDUP", F.col("order_no"), 10))).otherwise(F.array("claim_id"))
        return rows.withColumn("claim_id", F.explode(ids)).drop("order_no")

    def claims_lines(self) -> DataFrame:
        # whole numbers and days before the join: they are half as long as doubles and text in its shuffle
        li = self.star("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"),
            cents(F.col("l_extendedprice")).alias("billed"), F.to_date("l_shipdate").alias("shipped"))
        orders = self._with_terms(self.star("orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
        j = li.join(orders.select("o_orderkey", "o_custkey", "share"), F.col("l_orderkey") == F.col("o_orderkey"))
        qty, billed = F.col("qty"), F.col("billed")
        k = F.col("l_orderkey")
        line_id = F.concat_ws(
            "-", k.cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"), qty.cast("string"), billed.cast("string"),
            F.date_format("shipped", "yyyyMMdd"))
        return j.select(
            line_id.alias("claim_line_id"),
            code("CLM", k, 10).alias("claim_id"),
            F.col("l_linenumber").alias("line_no"),
            F.concat(F.lit("PX"), F.col("l_partkey").cast("string")).alias("procedure_code"),
            code("DX", (k * 7 + F.col("o_custkey")) % 26, 2).alias("diagnosis_code"),
            qty.alias("quantity"),
            # half up, in whole cents
            money_text(F.floor((billed * 2 + qty) / (qty * 2))).alias("unit_price_pkr"),
            money_text(billed).alias("line_billed_pkr"),
            money_text(idiv(billed * F.col("share"), 10000)).alias("line_approved_pkr"),
        )


def injected_defects(star: StarSource) -> DataFrame:
    """Manifest: how many rows each defect block changes, counted from the source keys alone."""
    b = F.col("o_orderkey") % 1000
    orders = star.star("orders").agg(
        F.count_if(b < 20).alias("duplicate_claims"),
        F.count_if(b.between(100, 114)).alias("null_values"),
        F.count_if(b.between(200, 202)).alias("orphan_fk_member"),
        F.count_if(b.between(203, 204)).alias("orphan_fk_provider"),
        F.count_if(b.between(300, 307)).alias("date_violations"),
        F.count_if(b.between(400, 405)).alias("amount_violations"),
        F.count_if(b.between(500, 502)).alias("nonpositive_amounts"),
    )
    members = star.star("customer").agg(
        F.count_if((F.col("c_custkey") % 250).isin(1, 2)).alias("impossible_ages"),
        F.count_if(F.col("c_custkey") % 20 == 0).alias("city_casing_members"),
    )
    providers = star.star("supplier").agg(F.count_if(F.col("s_suppkey") % 10 == 0).alias("city_casing_providers"))
    groups = star.star("nation").agg(F.count_if(F.col("n_nationkey") % 5 == 0).alias("city_casing_groups"))
    out = None
    for one_row in (orders, members, providers, groups):
        long = one_row.unpivot([], one_row.columns, "defect", "injected")
        out = long if out is None else out.unionByName(long)
    return out


def dirtied(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables with more defects: every rule of the catalogue fails on some row."""
    def put(df: DataFrame, tail: Column, **defects: dict) -> DataFrame:
        changed = {}
        for column, values in defects.items():
            c = F.col(column)
            for at, value in values.items():
                c = F.when(tail == at, value).otherwise(c)
            changed[column] = c
        return df.select(*(changed.get(c, F.col(c)).alias(c) for c in df.columns))

    def last(column: str, n: int) -> Column:
        return F.expr(f"try_cast(right({column}, {n}) AS int)")

    other_reason = F.when(F.col("denial_reason_code") == "", "DR01").otherwise("")
    return {
        **raw,
        "claims_header": put(
            raw["claims_header"], last("claim_id", 3), claim_id={601: "", 613: "CLM-same"}, member_id={602: ""}, provider_id={603: ""},
            status={604: "Lost"}, claim_type={605: "Spa"}, adjudication_mode={606: "Robot"},
            submission_date={607: "2025/13/45", 608: "2020-01-01", 611: "2031-01-01"}, denial_reason_code={609: other_reason},
            adjudication_date={610: "2031-01-01"}, payment_date={612: "2020-01-01"}),
        "claims_lines": put(
            raw["claims_lines"], last("claim_id", 3), claim_id={701: "", 702: "CLM-none"}, line_billed_pkr={703: "0.01"},
            claim_line_id={704: "LINE-same"}),
        "members": put(
            raw["members"], last("member_id", 2), date_of_birth={31: ""}, policy_id={32: ""}, gender={33: "X"},
            relationship={34: "Cousin"}, member_id={35: "MB-same", 36: "MB-same"}),
        "providers": put(
            raw["providers"], last("provider_id", 1), network_status={3: "Maybe"}, provider_type={4: "Spa"},
            provider_id={5: "PR-same", 6: "PR-same"}),
        "policies": put(raw["policies"], last("policy_id", 2), plan_tier={7: "Tin"}, copay_pct={8: "1.5"}),
    }


SNAPSHOTS = ("2024-07-01", "2025-02-01", "2025-09-01")


def member_snapshots(members: DataFrame) -> DataFrame:
    """The members as three snapshots show them: some move, some change their policy and back, some are missing for one
    snapshot, some come late or leave."""
    k = F.expr("try_cast(right(member_id, 4) AS int)")
    shown = members.select("member_id", "city", "policy_id")

    def at(n: int, seen: Column, city: Column | str = "city", policy: Column | str = "policy_id") -> DataFrame:
        return shown.filter(seen).select(
            "member_id", (F.col(city) if isinstance(city, str) else city).alias("city"),
            (F.col(policy) if isinstance(policy, str) else policy).alias("policy_id"), F.lit(SNAPSHOTS[n]).cast("date").alias("taken"))

    other = F.when(k % 5 == 0, "POL-other").otherwise(F.col("policy_id"))
    first = at(0, k % 7 != 0)
    second = at(1, k % 11 != 0, policy=other)
    third = at(2, k % 13 != 0, city=F.when(k % 3 == 0, "Elsewhere").otherwise(F.col("city")))
    return first.union(second).union(third)
