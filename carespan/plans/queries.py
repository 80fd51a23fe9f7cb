"""Every operator as a query over the driver's tables, read whole.

Line items joined to their orders stand in for claims: the order is the claim,
the customer the person, order and ship dates the admission and discharge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.operators import care, codes, consolidate, diagnosis, identity, normalize, person
from carespan.operators import parameters, policy, quality, reports, shape, stays
from carespan.plans import skew
from carespan.plans.claims import RAW_COLUMNS
from carespan.plans.pipeline import run_pipeline
from carespan.plans.session import tune
from carespan.sources import tables, typed
from carespan.sources.staging import fingerprint, new_path, resumable, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, folder: function(tune(spark), folder)
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def day(c: str) -> Column:
    return F.col(c).cast("date")


def br(c: str) -> Column:
    """A date as dd/mm/yyyy text."""
    iso = text(c)
    return F.concat_ws(
        "/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)
    )


def claims(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("COD_CONTROLE"),
        F.col("o_custkey").alias("ID_PESSOA"),
        F.col("l_linenumber").alias("NR_LINHA"),
        F.col("l_partkey").alias("COD_ITEM_PROD_MEDICA"),
        F.col("l_suppkey").alias("COD_PREST"),
        day("o_orderdate").alias("DT_INTERNACAO"),
        day("l_shipdate").alias("DT_ALTA"),
        day("l_shipdate").alias("DT_OCORR_EVENTO"),
        F.col("l_extendedprice").alias("VLR_PROD_MEDICA"),
        F.col("l_quantity").alias("QTDE_PROD_MEDICA"),
        F.col("l_returnflag").alias("TP_REDE"),
        F.col("l_linestatus").alias("TP_ACOMODACAO"),
        F.col("o_orderpriority").alias("TIPO_INTERNACAO"),
        F.col("o_orderstatus").alias("TIPO_REGIME"),
    )


def kept(df: DataFrame) -> DataFrame:
    """Claims for operators that read them several times: lines and orders are joined once."""
    return stage(df, "claims")


def identified_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims with identifier columns that are blank for some kinds of line."""
    net, room = F.col("TP_REDE"), F.col("TP_ACOMODACAO")
    return claims(spark, folder).select(
        text("COD_CONTROLE").alias("COD_CONTROLE"),
        "NR_LINHA",
        "VLR_PROD_MEDICA",
        F.when(net == "R", ".")
        .when((net == "A") & (room == "O"), "")
        .otherwise(text("ID_PESSOA"))
        .alias("COD_ENTIDADE_TS_SEGURADO"),
        F.when((net == "R") & (room == "F"), ".")
        .when(F.col("TIPO_REGIME") == "P", F.lit(None))
        .otherwise(text("COD_PREST"))
        .alias("NUM_AGR_INTER"),
        F.when(room == "O", "").otherwise(text("COD_ITEM_PROD_MEDICA")).alias("NUM_PEDIDO_INTER"),
        F.when(room == "O", " ").otherwise(text("NR_LINHA")).alias("NUM_SENHA_INTER"),
    )


def dated_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims whose dates are text, some of them missing or unreadable."""
    net, room, kind = F.col("TP_REDE"), F.col("TP_ACOMODACAO"), F.col("TIPO_INTERNACAO")

    return claims(spark, folder).select(
        F.when((net != "R") | (room != "O"), F.col("ID_PESSOA")).alias("ID_PESSOA"),
        "COD_CONTROLE",
        "NR_LINHA",
        F.when(net == "A", ".")
        .when((net == "N") & (kind == "1-URGENT"), "31/02/1999")
        .otherwise(br("DT_INTERNACAO"))
        .alias("DT_INTERNACAO"),
        F.when(room == "F", ".")
        .when(kind == "2-HIGH", "x")
        .otherwise(br("DT_ALTA"))
        .alias("DT_ALTA"),
        F.when(kind == "5-LOW", ".").otherwise(br("DT_OCORR_EVENTO")).alias("DT_OCORR_EVENTO"),
        F.when(kind == "3-MEDIUM", " ")
        .when(kind == "4-NOT SPECIFIED", ".")
        .otherwise(text("COD_PREST"))
        .alias("NUM_AGR_INTER"),
        F.when(net == "N", "1").otherwise(".").alias("REGIME_DOMICILIAR"),
    )


# --- text -----------------------------------------------------------------


@query
def normalize_text(spark, folder):
    return normalize.normalize_text(table(spark, folder, "documents"))


@query
def normalize_text_keep_signs(spark, folder):
    return normalize.normalize_text(table(spark, folder, "documents"), ["text"], removed=())


@query
def normalize_text_by_table(spark, folder):
    return normalize.normalize_by_table(table(spark, folder, "documents"), ["text"])


@query
def clean_description(spark, folder):
    return normalize.clean_descriptions(table(spark, folder, "documents"), ["text"]).select(
        "doc_id", "text"
    )


# --- care type, intensive care ---------------------------------------------


@query
def care_type(spark, folder):
    kind = F.col("event_type")
    df = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "view", " ")
        .when(kind == "click", ".")
        .when(kind == "error", F.lit(None))
        .when(kind == "signup", "")
        .otherwise(text("user_id"))
        .alias("NUM_AGR_INTER"),
        F.when(F.col("value") < 10, "1").otherwise(".").alias("REGIME_DOMICILIAR"),
    )
    return care.care_type(df)


@query
def icu_flag(spark, folder):
    line = F.col("l_linenumber")
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.when(F.col("l_quantity") > 48, F.lit(None))
        .otherwise(text("l_suppkey"))
        .alias("COD_ACOMODACAO_TISS"),
        F.when(F.col("l_returnflag") == "R", care.HASHED_MISSING)
        .otherwise(text("l_partkey"))
        .alias("COD_ACOMODACAO_TISS_PEDIDO"),
        F.when(line == 1, "UTI").when(line == 2, "UTI PEDIATRICA").otherwise("QUARTO").alias(
            "NOME_ACOMODACAO"
        ),
        F.when(line == 3, "ISOLAMENTO").otherwise("").alias("NOME_ACOMODACAO_PEDIDO"),
    )
    return care.icu_day(df).withColumnRenamed("CTI_DIARIA", "CTI_OBSERVADA").transform(
        lambda d: care.icu_day(d, mode="intended")
    )


@query
def icu_flag_by_table(spark, folder):
    """Intensive care by a list of codes for each of two columns, made from the parts."""
    part = table(spark, folder, "part")
    listed = part.select(text("p_partkey").alias("value"), "p_size")
    lists = [("COD_ACOMODACAO_TISS", 1, 12, 2, "SIM"), ("COD_ACOMODACAO_TISS_PEDIDO", 9, 30, 1, "TALVEZ")]
    rules = None
    for column, low, high, place, result in lists:
        own = listed.filter(F.col("p_size").between(low, high)).select(
            F.lit(place).alias("place"), F.lit(column).alias("column"), "value", F.lit(result).alias("result")
        )
        rules = own if rules is None else rules.unionByName(own)
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") > 48, F.lit(None)).otherwise(text("l_suppkey")).alias("COD_ACOMODACAO_TISS"),
        F.when(F.col("l_returnflag") == "R", care.HASHED_MISSING).otherwise(text("l_partkey")).alias("COD_ACOMODACAO_TISS_PEDIDO"),
    )
    return parameters.icu_day_by_table(df, rules, columns=parameters.ICU_COLUMNS[:2])


# --- person keys ----------------------------------------------------------


@query
def person_key_observed(spark, folder):
    return person.person_key(kept(identified_claims(spark, folder)))


@query
def person_key_intended(spark, folder):
    return person.person_key(kept(identified_claims(spark, folder)), mode="intended")


@query
def person_key_by_priority(spark, folder):
    return person.person_key(
        kept(identified_claims(spark, folder)),
        hierarchy=["COD_CONTROLE", "COD_ENTIDADE_TS_SEGURADO"],
    )


@query
def person_by_links(spark, folder):
    """Customers joined by their orders, and some by groups of seven orders."""
    client, order = F.col("ID_PESSOA"), F.col("COD_CONTROLE")
    df = claims(spark, folder).select(
        text(order).alias("COD_CONTROLE"),
        "NR_LINHA",
        F.when(F.col("TP_REDE") == "R", ".").otherwise(text(client)).alias("CLIENTE"),
        F.when(client % 67 == 0, F.concat(F.lit("g"), text(F.floor(order / 7)))).otherwise(" ").alias("GRUPO"),
    )
    return identity.person_by_links(kept(df), identifiers=["CLIENTE", "GRUPO", "COD_CONTROLE"])


@query
def person_by_links_giant(spark, folder):
    """All identifiers, of which suppliers and parts join nearly all rows."""
    return identity.person_by_links(kept(identified_claims(spark, folder)))


@query
def client_code_fill(spark, folder):
    df = identified_claims(spark, folder).drop("NUM_PEDIDO_INTER")
    return person.client_code(
        kept(df), fallbacks=["NUM_AGR_INTER", "NUM_SENHA_INTER"], parse="number", ties="one"
    )


@query
def client_code_all_owners(spark, folder):
    df = identified_claims(spark, folder).drop("NUM_PEDIDO_INTER")
    return person.client_code(kept(df), fallbacks=["NUM_AGR_INTER", "COD_CONTROLE"], parse="number")


@query
def client_code_report(spark, folder):
    df = person.client_code(
        kept(identified_claims(spark, folder)), fallbacks=["NUM_AGR_INTER"], ties="one"
    )
    return person.fill_report(df, client="COD_ENTIDADE_TS_SEGURADO")


# --- stays ----------------------------------------------------------------


@query
def fill_stay_dates(spark, folder):
    return stays.fill_stay_dates(dated_claims(spark, folder)).select(
        "COD_CONTROLE", "NR_LINHA", "DT_INTERNACAO", "DT_ALTA"
    )


@query
def repair_dates(spark, folder):
    return stays.repair_dates(dated_claims(spark, folder)).select(
        "COD_CONTROLE",
        "NR_LINHA",
        "DT_OCORR_EVENTO",
        "DT_INTERNACAO_CORRIGIDA",
        "DT_ALTA_CORRIGIDA",
    )


@query
def repair_dates_intended(spark, folder):
    return stays.repair_dates(dated_claims(spark, folder), mode="intended").select(
        "COD_CONTROLE",
        "NR_LINHA",
        "DT_OCORR_EVENTO",
        "DT_INTERNACAO_CORRIGIDA",
        "DT_ALTA_CORRIGIDA",
    )


def _stays(spark, folder, link):
    df = stays.repair_dates(claims(spark, folder), mode="intended").select(
        "COD_CONTROLE",
        "NR_LINHA",
        "ID_PESSOA",
        "DT_INTERNACAO_CORRIGIDA",
        "DT_ALTA_CORRIGIDA",
    )
    return stays.number_stays(kept(df), link=link)


@query
def stays_previous(spark, folder):
    return _stays(spark, folder, "previous")


@query
def stays_running_max(spark, folder):
    return _stays(spark, folder, "running_max")


STAY_COLUMNS = (
    "ID_PESSOA",
    "DT_INTERNACAO_CORRIGIDA",
    "DT_ALTA_CORRIGIDA",
    "ID_INTERNACAO",
)


@query
def stays_from_text(spark, folder):
    out = stays.consolidate_stays(kept(dated_claims(spark, folder)))
    return out.select("COD_CONTROLE", "NR_LINHA", *STAY_COLUMNS, "DT_INTERNACAO", "DT_ALTA")


@query
def stays_running_max_nulls(spark, folder):
    """Lines of which some have no person or no dates, linked to all before them."""
    out = stays.consolidate_stays(kept(dated_claims(spark, folder)), link="running_max")
    return out.select("COD_CONTROLE", "NR_LINHA", *STAY_COLUMNS, "DT_INTERNACAO", "DT_ALTA")


@query
def stays_resumed(spark, folder):
    """Stays of a run that finds all its stages kept by the run before."""
    place = new_path(spark, "resumed")
    inputs = [f"{folder}/{name}.parquet" for name in ("lineitem", "orders")]
    for _ in range(2):
        with resumable(spark, place, fingerprint(spark, inputs, "running_max")):
            out = _stays(spark, folder, "running_max")
    return out


@query
def stays_session(spark, folder):
    """Stays by session windows."""
    return _stays(spark, folder, "session")


@query
def stays_session_nulls(spark, folder):
    """By session windows, where some lines have no person or no dates."""
    out = stays.consolidate_stays(kept(dated_claims(spark, folder)), link="session")
    return out.select("COD_CONTROLE", "NR_LINHA", *STAY_COLUMNS, "DT_INTERNACAO", "DT_ALTA")


@query
def stays_without_dates(spark, folder):
    out = stays.consolidate_stays(kept(dated_claims(spark, folder)), stay_dates=False)
    return out.select("COD_CONTROLE", "NR_LINHA", *STAY_COLUMNS)


@query
def stays_preaggregated(spark, folder):
    df = claims(spark, folder).select(
        F.col("ID_PESSOA").alias("COD_CLIENTE"),
        F.when(F.col("TP_REDE") == "R", ".").otherwise(text("DT_INTERNACAO")).alias("DT_INTERNACAO"),
        F.when(F.col("TP_ACOMODACAO") == "O", ".").otherwise(text("DT_ALTA")).alias("DT_ALTA"),
        text("DT_OCORR_EVENTO").alias("DT_OCORR_EVENTO"),
    )
    return stays.stays_preaggregated(df)


@query
def readmission_gap(spark, folder):
    return stays.readmission_gap(kept(_stays(spark, folder, "running_max")), within_days=30)


@query
def readmission_gap_observed(spark, folder):
    df = stays.consolidate_stays(kept(dated_claims(spark, folder)))
    df = df.select("COD_CONTROLE", "NR_LINHA", *STAY_COLUMNS, "DT_INTERNACAO", "DT_ALTA")
    return stays.readmission_gap(kept(df), mode="observed")


@query
def first_claim(spark, folder):
    df = claims(spark, folder).select(
        "ID_PESSOA", "COD_CONTROLE", "NR_LINHA", "DT_OCORR_EVENTO"
    )
    return consolidate.first_claim(df, stay="ID_PESSOA")


@query
def first_claim_observed(spark, folder):
    df = claims(spark, folder).select(
        "ID_PESSOA", "COD_CONTROLE", "NR_LINHA", "DT_OCORR_EVENTO"
    )
    return consolidate.first_claim(df, stay="ID_PESSOA", mode="observed")


# --- value-weighted consolidation -------------------------------------------


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("COD_CONTROLE"),
        F.col("l_linenumber").alias("NR_LINHA"),
        F.col("l_extendedprice").alias("VLR_PROD_MEDICA"),
        F.col("l_quantity").alias("QTDE_PROD_MEDICA"),
        F.col("l_returnflag").alias("TP_REDE"),
        F.col("l_linestatus").alias("TP_ACOMODACAO"),
    )


@query
def consolidate_max(spark, folder):
    return consolidate.consolidate(
        _lines(spark, folder), unit="COD_CONTROLE", parse="number", ties="one", replace=False
    )


@query
def consolidate_min(spark, folder):
    return consolidate.consolidate(
        _lines(spark, folder),
        unit="COD_CONTROLE",
        value="QTDE_PROD_MEDICA",
        agg="minimum",
        parse="number",
        ties="one",
        replace=False,
    )


@query
def consolidate_ties_all(spark, folder):
    return consolidate.consolidate(
        _lines(spark, folder),
        attribute="TP_ACOMODACAO",
        unit="COD_CONTROLE",
        value="QTDE_PROD_MEDICA",
        parse="number",
    )


@query
def consolidate_money_text(spark, folder):
    money = F.replace(text("VLR_PROD_MEDICA"), F.lit("."), F.lit(","))
    df = claims(spark, folder).select(
        "ID_PESSOA", "COD_CONTROLE", "NR_LINHA", "TIPO_INTERNACAO", money.alias("VLR_PROD_MEDICA")
    )
    return consolidate.consolidate(
        df, attribute="TIPO_INTERNACAO", unit="ID_PESSOA", ties="one", replace=False
    )


@query
def consolidation_report(spark, folder):
    df = consolidate.consolidate(
        _lines(spark, folder), unit="COD_CONTROLE", parse="number", ties="one", replace=False
    )
    out = consolidate.change_report(
        df,
        attribute="TP_REDE",
        corrected="TP_REDE_CORRIGIDA",
        value="VLR_PROD_MEDICA",
        parse="number",
    )
    return out.withColumns(
        {c: F.round(c, 2) for c in ("value_before", "value_after")}
    )


def _birth_dates(spark, folder):
    return claims(spark, folder).select(
        F.col("ID_PESSOA").alias("COD_CLIENTE"),
        "COD_CONTROLE",
        "NR_LINHA",
        F.replace(text("VLR_PROD_MEDICA"), F.lit("."), F.lit(",")).alias("VLR_PROD_MEDICA"),
        text("DT_INTERNACAO").alias("DT_NASCIMENTO_CLIENTE"),
    )


@query
def birth_date_by_value(spark, folder):
    return consolidate.consolidate_birth_date(_birth_dates(spark, folder))


@query
def birth_date_intended(spark, folder):
    return consolidate.consolidate_birth_date(_birth_dates(spark, folder), mode="intended")


def _discharges(spark, folder):
    return claims(spark, folder).select(
        F.col("ID_PESSOA").alias("ID_INTERNACAO"),
        "COD_CONTROLE",
        "VLR_PROD_MEDICA",
        "TIPO_INTERNACAO",
        F.when(F.col("TP_REDE") == "R", "OBITO")
        .when(F.col("TP_REDE") == "A", "ALTA POR ÓBITO")
        .otherwise("ALTA")
        .alias("TIPO_ALTA"),
    )


@query
def discharge_type(spark, folder):
    return consolidate.discharge_and_stay_type(_discharges(spark, folder), parse="number")


@query
def stay_type_report(spark, folder):
    before = _discharges(spark, folder)
    after = consolidate.discharge_and_stay_type(before, parse="number", collapse_to_claim=False)
    return consolidate.stay_type_report(before, after)


def _diagnoses(spark, folder):
    net, room, state = F.col("TP_REDE"), F.col("TP_ACOMODACAO"), F.col("TIPO_REGIME")
    return claims(spark, folder).select(
        F.col("COD_CONTROLE").alias("COD_CONTROLE2"),
        "NR_LINHA",
        "QTDE_PROD_MEDICA",
        F.when(net == "R", "").when(net == "A", "A10").otherwise("B20").alias("CID_SAIDA"),
        F.when(room == "O", " ")
        .otherwise(F.concat(F.lit("C1"), text("NR_LINHA")))
        .alias("CID_PRINC_ENTRADA"),
        F.when(state == "P", F.lit(None))
        .otherwise(F.concat(F.lit("D2"), text("NR_LINHA")))
        .alias("CID_SEC_ENTRADA"),
    )


@query
def diagnosis_priority(spark, folder):
    return diagnosis.consolidate_diagnosis(_diagnoses(spark, folder), value="QTDE_PROD_MEDICA")


@query
def diagnosis_filled(spark, folder):
    return diagnosis.consolidate_diagnosis(
        _diagnoses(spark, folder), value="QTDE_PROD_MEDICA", max_over="filled", ties="one"
    )


# --- codes ----------------------------------------------------------------


def _code_tables(spark, folder):
    part = table(spark, folder, "part")
    names = dict(
        zip(
            codes.CODE_TABLES,
            ["ECONOMY", "PROMO", "SMALL", "MEDIUM", "STANDARD", "LARGE"],
            strict=False,
        )
    )
    sources = {
        name: part.filter(F.col("p_type") == kind) for name, kind in names.items()
    } | {codes.CODE_TABLES[-1]: part}
    return {
        name: df.select(
            F.col("p_partkey").alias(codes.FROM_CODE),
            (F.col("p_partkey") - F.col("p_size")).alias(codes.TO_CODE),
        )
        for name, df in sources.items()
    }


@query
def code_tables_union(spark, folder):
    attributes = table(spark, folder, "part").select(
        F.col("p_partkey").alias(codes.ATTRIBUTE_KEY), "p_brand"
    )
    return codes.combine_code_tables(_code_tables(spark, folder), attributes)


@query
def code_table_folder(spark, folder):
    """The code tables written to a folder, found and read again, and combined."""
    root = new_path(spark, "code-tables")
    for name, df in _code_tables(spark, folder).items():
        df.write.parquet(f"{root}/{name.replace('_', ' ').lower()}")
    return codes.combine_code_tables(tables.read_code_tables(spark, root))


def _edges(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias(codes.FROM_CODE),
        (F.col("p_partkey") - F.col("p_size")).alias(codes.TO_CODE),
    )


@query
def code_closure(spark, folder):
    return codes.code_closure(_edges(spark, folder))


@query
def code_closure_cycles(spark, folder):
    """Every chain of parts goes up and starts over, so most run into a cycle."""
    part = table(spark, folder, "part")
    to = (F.col("p_partkey") + F.col("p_size") % 7 * 5) % F.lit(part.count())
    return codes.code_closure(
        part.select(F.col("p_partkey").alias(codes.FROM_CODE), to.alias(codes.TO_CODE))
    )


def _branching(spark, folder):
    """Codes with two targets each, some of which lead round in circles of two."""
    key = F.col("p_partkey")
    twin = F.when(key % 50 == 48, key + 1).when(key % 50 == 49, key - 1)
    targets = F.array_compact(F.array(F.floor(key / 2), F.floor(key / 3), twin)).cast("array<long>")
    return table(spark, folder, "part").select(
        key.alias(codes.FROM_CODE), F.explode(targets).alias(codes.TO_CODE)
    )


@query
def code_ends_all(spark, folder):
    """Every end that a code's mappings lead to, and in how many steps at least."""
    return codes.reachable_ends(_branching(spark, folder))


@query
def code_ends_last(spark, folder):
    """Where a code has several targets and only the last one counts."""
    return codes.reachable_ends(_branching(spark, folder), targets="largest")


@query
def code_table_end_codes(spark, folder):
    return codes.add_end_code(_edges(spark, folder))


def _items(spark, folder):
    line, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("COD_ITEM_PROD_MEDICA"),
        F.col("p_name").alias("DS_PROD_MEDICA"),
        "p_brand",
    )


@query
def standard_description(spark, folder):
    closure = codes.code_closure(_edges(spark, folder))
    return codes.standardize_codes(_items(spark, folder).drop("p_brand"), closure)


@query
def standard_description_observed(spark, folder):
    return codes.standardize_codes(
        _items(spark, folder).drop("COD_ITEM_PROD_MEDICA"), code="p_brand", mode="observed"
    )


@query
def product_type(spark, folder):
    kind = F.col("p_type")
    df = table(spark, folder, "part").select(
        "p_partkey",
        F.when(kind == "ECONOMY", "MEDICAMENTOS")
        .when(kind == "PROMO", "")
        .when(kind == "SMALL", "PROCEDIMENTOS MÉDICOS")
        .when(kind == "LARGE", "PROCEDIMENTOS MEDICOS")
        .otherwise(kind)
        .alias("TIPO_TABELA"),
        F.when(F.col("p_size") > 25, "").otherwise(F.col("p_brand")).alias("TIPO_PROD_MEDICA"),
    )
    df = codes.product_type(df)
    return codes.product_type(df, out="TIPO_PRETENDIDO", mode="intended")


# --- policy holder ----------------------------------------------------------


def _policies(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("COD_CONTROLE2"),
        F.when(F.col("o_orderstatus") == "P", ".")
        .otherwise(F.col("o_orderpriority"))
        .alias("ID_GRUPO"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.col("o_orderstatus"))
        .alias("CODIGO_ESTIPULANTE"),
        F.substring("o_orderpriority", 1, 1).alias("NR_CONTRATO"),
    )


@query
def policy_holder_observed(spark, folder):
    return policy.consolidate_policy_holder(_policies(spark, folder), mode="observed")


@query
def policy_holder_intended(spark, folder):
    return policy.consolidate_policy_holder(_policies(spark, folder))


# --- shape, checks, reports ---------------------------------------------------


@query
def csv_round_trip(spark, folder):
    """Documents written as CSV and read as all-text claims, value for value.

    With an index column, quotes, commas, line breaks, empty texts and gaps.
    """
    path = new_path(spark, "csv")
    df = table(spark, folder, "documents").withColumns(
        {
            "Unnamed: 0": F.lit("0"),
            "quoted": F.concat(F.lit('"'), F.col("lang"), F.lit('", \\ "'), F.col("source")),
            "gap": F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "x"),
        }
    )
    tables.write_csv(tables.all_text(df), path)
    return tables.read_claims_csv(spark, path, columns=df.columns, multi_line=True)


LINE_TYPES = {"pedido": "integer", "cliente": "integer", "valor": "number", "data": "date"}


def _loaded_lines(spark, folder):
    """Orders as lines with semicolons in Latin-1, some bad in one of four ways, read by type."""
    path = new_path(spark, "claim-lines")
    way = F.col("o_orderkey") % 10
    fields = [
        text("o_orderkey"),
        F.when(way == 6, "x").otherwise(text("o_custkey")),
        F.when(way == 5, "abc").when(way == 8, "").otherwise(text(F.floor("o_totalprice"))),
        F.when(way == 6, "31/02/2020").otherwise(br("o_orderdate")),
        F.concat(F.lit('"São; '), F.col("o_orderpriority"), F.lit('"')),
    ]
    line = F.concat_ws(";", *fields)
    line = F.when(way == 3, F.concat(line, F.lit(";mais"))).when(way == 4, F.concat_ws(";", *fields[:3])).otherwise(line)
    # one column whose text is left as it is
    as_is = {"sep": "\x01", "quote": "", "encoding": "ISO-8859-1", "escapeQuotes": "false"}
    table(spark, folder, "orders").select(line).write.options(**as_is).csv(path)
    return typed.read_claims_typed(
        spark, path, LINE_TYPES, sep=";", encoding="ISO-8859-1", columns=[*LINE_TYPES, "nota"],
        header=False, quarantine=new_path(spark, "bad-lines"),
    )


@query
def csv_typed(spark, folder):
    """The lines that are good, by their declared types."""
    return _loaded_lines(spark, folder).good


@query
def csv_quarantine(spark, folder):
    """The lines that are bad, and why."""
    return _loaded_lines(spark, folder).bad.select("line", "reason")


@query
def translate_columns(spark, folder):
    names = {"c_custkey": "COD_CLIENTE", "c_name": "NOME", "c_nationkey": "UF", "absent": "X"}
    return shape.translate_columns(table(spark, folder, "customer"), names)


@query
def remove_rows(spark, folder):
    return shape.remove_rows(
        table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"),
        "o_orderpriority",
        ["1-URGENT", "5-LOW"],
    )


@query
def remove_rows_long(spark, folder):
    """A list of 1,500 values, none of them missing."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey")
    return shape.remove_rows(orders, "o_orderkey", range(0, 15_000, 10))


@query
def remove_rows_missing(spark, folder):
    """A missing value in the list leaves no row, however long the list is."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey")
    return shape.remove_rows(orders, "o_orderkey", [*range(0, 15_000, 10), None])


def _customers_of(spark, folder, nations):
    return table(spark, folder, "customer").filter(F.col("c_nationkey").isin(nations)).select("c_custkey")


def _orders_with_gaps(spark, folder):
    """Orders, the least urgent without a customer."""
    known = F.col("o_orderpriority") != "5-LOW"
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(known, F.col("o_custkey")).alias("o_custkey")
    )


@query
def remove_listed(spark, folder):
    """Orders of customers that a table does not list."""
    listed = _customers_of(spark, folder, [1, 5, 9])
    return shape.remove_listed(_orders_with_gaps(spark, folder), listed, "o_custkey")


@query
def remove_listed_text(spark, folder):
    """The list holds text, each value several times."""
    listed = table(spark, folder, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return shape.remove_listed(
        _orders_with_gaps(spark, folder), listed.select("o_orderpriority", text("o_custkey").alias("v")), "o_custkey", "v"
    )


@query
def remove_listed_gaps(spark, folder):
    """A list with a missing value leaves nothing, one without any value everything."""
    orders, none = _orders_with_gaps(spark, folder), _customers_of(spark, folder, [-1])
    some = _customers_of(spark, folder, [1]).unionByName(orders.select(F.col("o_custkey").alias("c_custkey")))
    cut = shape.remove_listed(orders, some, "o_custkey").withColumn("list", F.lit("missing"))
    return cut.unionByName(shape.remove_listed(orders, none, "o_custkey").withColumn("list", F.lit("none")))


@query
def append_or_create(spark, folder):
    """Orders in two batches, the second with its columns in another order."""
    name = f"batches_{uuid.uuid4().hex}"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    first = F.col("o_orderpriority") < "3"
    tables.append_or_create(orders.filter(first), name)
    tables.append_or_create(orders.filter(~first).select(*reversed(orders.columns)), name)
    return spark.table(name)


@query
def salted_lookup(spark, folder):
    """Lines with their flag's count and total, each flag's lines dealt out over tasks."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    totals = lines.groupBy("l_returnflag").agg(skew.row_count(), F.sum("l_quantity").cast("long").alias("quantity"))
    return skew.attach(lines.drop("l_quantity"), totals, ["l_returnflag"], limit=500)


@query
def count_rows(spark, folder):
    return shape.count_rows(table(spark, folder, "orders"), "orders")


CHECKED = {"NUM_AGR_INTER": 0.8, "NUM_PEDIDO_INTER": 0.8, "COD_ENTIDADE_TS_SEGURADO": 0.5}


@query
def completeness(spark, folder):
    out = quality.completeness(identified_claims(spark, folder), CHECKED)
    return out.withColumn("filled_share", F.round("filled_share", 6))


@query
def completeness_failures(spark, folder):
    out = quality.completeness(identified_claims(spark, folder), CHECKED, failing_only=True)
    return out.withColumn("filled_share", F.round("filled_share", 6))


def _checked(spark, folder):
    df = dated_claims(spark, folder)
    kind = F.col("REGIME_DOMICILIAR")
    return df.withColumns(
        {
            "CID_SAIDA": F.when(kind == "1", "A10").otherwise(F.lit("a1")),
            "UF_PRESTADOR": F.when(kind == "1", "BA").otherwise(F.lit(None)),
            "NR_CNPJ": F.concat(
                F.lpad(text("COD_CONTROLE"), 11, "1"), F.lpad(text("NR_LINHA"), 3, "8")
            ),
            "E_MAIL": F.when(kind == "1", "a@b").otherwise("@"),
        }
    )


CHECK_RULES = {
    "DT_INTERNACAO": "date",
    "DT_ALTA": "date",
    "NUM_AGR_INTER": "integer",
    "REGIME_DOMICILIAR": "float",
    "CID_SAIDA": "cid",
    "UF_PRESTADOR": "uf",
    "COD_CONTROLE": "string",
    "NR_CNPJ": "cnpj",
    "E_MAIL": "email",
}


@query
def rule_violations(spark, folder):
    return quality.rule_violations(_checked(spark, folder), CHECK_RULES)


@query
def rule_invalid_values(spark, folder):
    return quality.invalid_values(
        _checked(spark, folder), CHECK_RULES, keys=["COD_CONTROLE", "NR_LINHA"]
    )


def _report(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("TP_REDE_VIDAS"),
        F.col("l_extendedprice").alias("CUSTO_POTENCIAL"),
        F.col("l_linestatus").alias("TP_ACOMODACAO_CIG"),
        F.concat("l_returnflag", "l_linestatus").alias("TP_ACOMODACAO_DETALHEVIDAS"),
    )


@query
def cost_by_network(spark, folder):
    out = reports.cost_by_network(_report(spark, folder))
    return out.withColumn("CUSTO_POTENCIAL", F.round("CUSTO_POTENCIAL", 2))


@query
def count_by_accommodation(spark, folder):
    return reports.count_by_accommodation(_report(spark, folder), out="QTD_POR_ACOMODACAO")


@query
def share_by_accommodation(spark, folder):
    out = reports.share_by_accommodation(_report(spark, folder))
    return out.withColumn("percent_count", F.round("percent_count", 6))


@query
def total_cost(spark, folder):
    out = reports.total_cost(_report(spark, folder))
    return out.withColumn("CUSTO_POTENCIAL", F.round("CUSTO_POTENCIAL", 2))


def _rounded_reports(df):
    return df.withColumns({"cost": F.round("cost", 2), "share": F.round("share", 6)})


@query
def summary_reports(spark, folder):
    """All four reports from one scan."""
    return _rounded_reports(reports.summary_reports(_report(spark, folder)))


# --- the whole pipeline -------------------------------------------------------


def raw_claims(spark: SparkSession, folder: str) -> DataFrame:
    """All raw claims columns as text, made from lines, orders and parts."""
    net, room, kind = F.col("TP_REDE"), F.col("TP_ACOMODACAO"), F.col("TIPO_INTERNACAO")
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("COD_ITEM_PROD_MEDICA"), "p_name", "p_brand", "p_type"
    )
    df = claims(spark, folder).join(part, "COD_ITEM_PROD_MEDICA")

    made = {
        "COD_CONTROLE": text("COD_CONTROLE"),
        "COD_PREST": text("COD_PREST"),
        "TP_REDE": net,
        "COD_CLIENTE": text("ID_PESSOA"),
        "DT_NASCIMENTO_CLIENTE": br("DT_INTERNACAO"),
        "SEXO_CLIENTE": F.when(room == "O", "M").otherwise("F"),
        "TP_ACOMODACAO": room,
        "NUM_AGR_INTER": F.when(kind == "3-MEDIUM", " ").otherwise(text("COD_PREST")),
        "TIPO_ALTA": F.when(net == "R", "Óbito").otherwise("Alta"),
        "TIPO_REGIME": F.col("TIPO_REGIME"),
        "CID_PRINC_ENTRADA": F.when(room == "O", "").otherwise("C16"),
        "CID_SEC_ENTRADA": F.lit("D20"),
        "CID_SAIDA": F.when(net == "A", F.lit(None)).otherwise(F.concat(F.lit("A1"), text("NR_LINHA"))),
        "NUM_PEDIDO_INTER": text("COD_ITEM_PROD_MEDICA"),
        "TIPO_INTERNACAO": kind,
        "NUM_SENHA_INTER": text("NR_LINHA"),
        "DT_OCORR_EVENTO": br("DT_OCORR_EVENTO"),
        "COD_ITEM_PROD_MEDICA": text("COD_ITEM_PROD_MEDICA"),
        "DS_PROD_MEDICA": F.concat_ws(" - ", "p_name", "p_brand"),
        "TIPO_TABELA": F.when(F.col("p_type") == "ECONOMY", "Medicamentos").otherwise(F.col("p_type")),
        "TIPO_PROD_MEDICA": F.when(room == "O", "").otherwise("HONORARIO"),
        "QTDE_PROD_MEDICA": text(F.col("QTDE_PROD_MEDICA").cast("int")),
        "VLR_PROD_MEDICA": F.replace(text("VLR_PROD_MEDICA"), F.lit("."), F.lit(",")),
        "UF_EXECUTANTE": F.when(room == "O", "BA").otherwise("RJ"),
        "NOME_ACOMODACAO": F.when(net == "N", "UTI").otherwise("QUARTO"),
        "DT_INTERNACAO": F.when(net == "A", ".").otherwise(br("DT_INTERNACAO")),
        "DT_ALTA": F.when(room == "F", ".").otherwise(br("DT_ALTA")),
        "COD_ACOMODACAO_TISS": F.when(F.col("p_brand") == "Brand#7", care.HASHED_MISSING).otherwise(
            text("NR_LINHA")
        ),
        "COD_ACOMODACAO_TISS_PEDIDO": text("NR_LINHA"),
        "COD_ENTIDADE_TS_SEGURADO": F.when(net == "R", ".").otherwise(text("ID_PESSOA")),
        "ID_GRUPO": F.when(room == "O", ".").otherwise(F.col("TIPO_REGIME")),
        "CODIGO_ESTIPULANTE": F.substring("TIPO_INTERNACAO", 1, 1),
        "NR_CONTRATO": F.substring("TIPO_INTERNACAO", 1, 1),
        "REGIME_DOMICILIAR": F.when(net == "N", "1").otherwise("."),
    }
    return df.select(
        *[made.get(c, F.lit(".") if c != "NR_CNPJ" else F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    )


def _odd_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Raw claims whose money, number and code columns hold texts that only look right."""
    odd = F.array(*[F.lit(x) for x in ("nan", "Infinity", "12F", "0x1p3", "1.234,5", "12", "A10\n", "", ".")])
    pick = F.get(odd, (text("NR_LINHA_N").cast("int") + F.length("COD_CONTROLE")) % 9)
    df = raw_claims(spark, folder).withColumn("NR_LINHA_N", F.col("NUM_SENHA_INTER"))
    named = ("VLR_PROD_MEDICA", "QTDE_PROD_MEDICA", "CID_SAIDA", "COD_CLIENTE", "NR_CNPJ")
    return df.withColumns({c: pick for c in named}).drop("NR_LINHA_N")


@query
def completeness_claims(spark, folder):
    """The shipped limits of all raw columns."""
    out = quality.completeness(_odd_claims(spark, folder))
    return out.withColumn("filled_share", F.round("filled_share", 6))


@query
def rule_violations_claims(spark, folder):
    """The shipped rules of the raw columns."""
    return quality.rule_violations(_odd_claims(spark, folder), failing_only=False)


@query
def full_pipeline(spark, folder):
    closure = codes.code_closure(_edges(spark, folder))
    return run_pipeline(raw_claims(spark, folder), closure, keep_unmapped=True)


@query
def full_pipeline_observed(spark, folder):
    return run_pipeline(raw_claims(spark, folder), mode="observed")


@query
def pipeline_reports(spark, folder):
    """All four reports of the pipeline's result."""
    names = {"network": "TP_REDE", "accommodation": "TP_ACOMODACAO", "detail": "TIPO_INTERNACAO"}
    return _rounded_reports(
        reports.summary_reports(QUERIES["full_pipeline"](spark, folder), cost="VLR_PROD_MEDICA", **names)
    )
