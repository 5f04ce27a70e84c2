"""The tables, feeds and steps of the daily run, as plain data.

Names, column lists and page keys are fixed values of the source systems. Columns and types that the source
systems do not document are arguments of the jobs, not guesses made here.
"""

from __future__ import annotations

from dataclasses import dataclass

# stages of a daily chain, in order, as they appear in step names
LOAD, REFRESH, ADDRESS, PUBLISH = "legacy_to_lv0", "lv0_dag", "lv1ex_dag", "lv1_dag"

SNAPSHOT_STEP = "backup_dag.ADDRESS_MASTER_LOG"
PARTITION_STEP = "single_dag.CREATE_ADDRESS_MASTER_LOG"
REVERSE_STEPS = {"product": "single_dag.PRODUCT", "promotion": "single_dag.PROMOTION"}


def step_name(stage: str, schema: str, table: str) -> str:
    return f"{stage}_{schema}.{table}"


@dataclass(frozen=True)
class SourceTable:
    """How one business table is read and what is built from it."""

    schema: str
    name: str
    page_key: str | None = None  # order of the numbered pages; None is a full read
    page_rows: int | None = None
    columns: tuple[str, ...] | None = None
    strip_nul: bool = False
    decrypt: tuple[tuple[str, str], ...] = ()
    month_days: tuple[int, ...] | None = None  # None is every day
    clean_name: str | None = None  # table of the clean layer, None where no step of its own makes one
    published: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()  # published tables a child row needs

    @property
    def raw_name(self) -> str:
        return self.name.lower()

    def step(self, stage: str) -> str:
        return step_name(stage, self.schema, self.name)

    def runs_on(self, day_of_month: int) -> bool:
        return self.month_days is None or day_of_month in self.month_days


# fixed values: the 31 columns read from the reservation table
RESERVATION_COLUMNS = (
    "ORDER_NO", "SEQ", "CUST_NM", "SALES_CHANNEL", "SALES_GRP", "VISIT_DT", "VISIT_NUM", "TEL_NO", "TEL_NO2",
    "GOODS_CD", "GOODS_NM", "HOMEPAGE_ID", "REMARK", "VISIT_STATUS", "VISIT_COMPLATE_DATE", "ROUTE", "ROUTE_CD",
    "CONTRACT_YN", "CONTRACT_DATE", "CONTRACT_ORDER_NO", "MKT_FLAG", "MKT_DT", "INSRT_USER_ID", "INSRT_DT",
    "UPDT_USER_ID", "UPDT_DT", "REF_ORDER_NO", "RECOMMEND_ORDER_NO", "INPUT_TYPE", "MASSAGE_POINT", "MASSAGE_EXP",
)

# fixed values: the source tables, page keys and page sizes
SOURCE_TABLES = (
    SourceTable("RENTAL", "R_ACQ_INTRO"),
    SourceTable("RENTAL", "R_BIZ_MSG_TEMPLATE"),
    SourceTable("RENTAL", "R_CALL_GROUP", clean_name="r_call_group"),
    SourceTable(
        "RENTAL", "R_CONTRACT_CANCEL_RECEIPT", "INSRT_DT", 100_000, strip_nul=True,
        clean_name="r_contract_cancel_receipt", published=("contract_cancel_receipt",),
    ),
    SourceTable(
        "RENTAL", "R_CONTRACT_MOVE_RECEIPT",
        clean_name="r_contract_move_receipt", published=("contract_move_receipt",),
    ),
    SourceTable(
        "RENTAL", "R_CRM_INFO", "ZIP_SEQ", 100_000, strip_nul=True, month_days=(1, 8, 15, 22, 29)
    ),
    SourceTable(
        "RENTAL", "R_EXHIBITION_VISIT_HISTORY", clean_name="r_exhibition_visit",
        published=("exhibition_visit_customer", "exhibition_visit_history"),
        parents=("exhibition_visit_customer",),
    ),
    SourceTable(
        "RENTAL", "R_EXPERIENCE_RESERVATION", columns=RESERVATION_COLUMNS, strip_nul=True,
        clean_name="r_experience_reservation", published=("experience_reservation_customer", "lead"),
        parents=("experience_reservation_customer",),
    ),
    SourceTable("RENTAL", "R_GOODS", clean_name="r_goods", published=("product2",)),
    SourceTable("RENTAL", "R_INSTALL_FEE", clean_name="r_install_fee"),
    SourceTable(
        "RENTAL", "R_ORDER_CONTRACT", "INSRT_DT", 10_000, strip_nul=True,
        clean_name="r_order_contract", published=("opportunity",),
    ),
    SourceTable("RENTAL", "R_ORDER_CONTRACT_ADD", "INSRT_DT", 100_000, strip_nul=True),
    SourceTable("RENTAL", "R_ORDER_CUST_INFO", "INSRT_DT", 100_000),
    SourceTable("RENTAL", "R_PROD_SYMPTOM_DTL", clean_name="r_svc_type_mid"),
    SourceTable("RENTAL", "R_PROD_SYMPTOM_HDR", clean_name="r_svc_type_big"),
    SourceTable("RENTAL", "R_PROD_SYMPTOM_SML", clean_name="r_svc_type_sml"),
    SourceTable("RENTAL", "R_PROMOTION", clean_name="r_promotion", published=("promotion",)),
    SourceTable(
        "RENTAL", "R_SERVICE_EVALUATION", "EVAL_SEQ", 100_000, strip_nul=True,
        clean_name="r_service_evaluation", published=("service_evaluation",),
    ),
    SourceTable(
        "RENTAL", "R_SERVICE_RECEIPT", "INSRT_DT", 100_000, strip_nul=True,
        decrypt=(("TEL_NO", "DEC_TEL_NO"), ("HAND_TEL_NO", "DEC_HAND_TEL_NO")),
        clean_name="r_service_receipt", published=("service_receipt",),
    ),
    SourceTable(
        "RENTAL", "R_SHIPPING_EVALUATION", "EVAL_SEQ", 100_000, strip_nul=True,
        clean_name="r_shipping_evaluation", published=("shipping_evaluation",), parents=("shipping_info",),
    ),
    SourceTable(
        "RENTAL", "R_SHIPPING_INFO", "INSRT_DT", 100_000, strip_nul=True,
        clean_name="r_shipping_info", published=("shipping_info",),
    ),
    SourceTable("RENTAL", "R_TRANS_HOMEPAGE", clean_name="r_trans_homepage"),
    SourceTable(
        "RENTAL", "V_CUSTOMER", "INSRT_DT", 100_000, clean_name="v_customer", published=("account",)
    ),
    SourceTable("RENTAL", "V_ERP_USER", clean_name="v_erp_user"),
    SourceTable("RENTAL", "V_HOME_CARE", "CONT_DT", 10_000, strip_nul=True),
    SourceTable(
        "RENTAL", "V_SALES_LOUNGE", clean_name="v_sales_lounge", published=("bbs_map",),
        parents=("b_sales_org", "b_sales_grp"),
    ),
    SourceTable("UNIERP5", "B_ITEM_GROUP", clean_name="b_item_group"),
    SourceTable("UNIERP5", "B_MAJOR", clean_name="code_master"),
    SourceTable("UNIERP5", "B_MINOR"),
    SourceTable("UNIERP5", "B_SALES_GRP", clean_name="b_sales_grp"),
    SourceTable("UNIERP5", "B_SALE_ORG", clean_name="b_sales_org"),
)

TABLES = {t.name: t for t in SOURCE_TABLES}


@dataclass(frozen=True)
class Feed:
    """A public feed: where its rows are in a page and which columns they have."""

    name: str
    columns: tuple[str, ...]
    path: str | None = None  # JSON path of the row list; None is XML
    status_path: str | None = None
    strict: bool = False  # a missing key is an error
    categories: tuple[str, ...] = ()
    first_page: int = 1

    @property
    def step(self) -> str:
        return step_name(LOAD, "DATAAPI", self.name.upper())


# fixed values: column names of the feeds
FEEDS = {
    "care_center": Feed(
        "care_center", ("번호", "시도", "시군구", "산후조리원", "주소", "전화번호", "일반실", "특실"), path="data"
    ),
    "welfare_center": Feed(
        "welfare_center", ("번호", "시도", "기관명", "주소", "전화번호", "운영주체", "법인유형"), path="data"
    ),
    "school": Feed(
        "school",
        ("seq", "adres", "schoolName", "region", "estType", "schoolGubun", "link", "campusName"),
        path="dataSearch.content",
        categories=("elem_list", "midd_list", "high_list", "univ_list", "seet_list"),
    ),
    "town_hall": Feed(
        "town_hall",
        (
            "flctNm", "flctTyp", "lctnRoadNmAddr", "lctnLotnoAddr", "lat", "lot", "busiCodNm", "telno", "builYmd",
            "builArea", "mngInstNm", "crtrYmd", "insttCode",
        ),
        path="response.body.items",
        status_path="response.header.resultCode",
        strict=True,
        first_page=0,
    ),
    "hospital": Feed(
        "hospital",
        (
            "dgidIdName", "dutyAddr", "dutyEryn", "dutyHano", "dutyHayn", "dutyName", "dutyTel1", "dutyTel3",
            "dutyTime1c", "dutyTime1s", "dutyTime2c", "dutyTime2s", "dutyTime3c", "dutyTime3s", "dutyTime4c",
            "dutyTime4s", "dutyTime5c", "dutyTime5s", "dutyTime6c", "dutyTime6s", "hpbdn", "hperyn", "hpgryn", "hpid",
            "hpopyn", "MKioskTy1", "MKioskTy10", "MKioskTy11", "MKioskTy2", "MKioskTy25", "MKioskTy3", "MKioskTy4",
            "MKioskTy5", "MKioskTy6", "MKioskTy7", "MKioskTy8", "MKioskTy9", "o001", "o003", "o004", "o006", "o007",
            "o015", "o018", "o022", "o025", "o027", "o028", "o029", "o030", "o033", "o034", "o036", "o038",
            "postCdn1", "postCdn2", "wgs84Lat", "wgs84Lon",
        ),
    ),
}

# result column -> feed column of the joint institution table
INSTITUTION_MAPPINGS = {
    "care_center": {"name": "산후조리원", "addr": "주소", "tel": "전화번호"},
    "welfare_center": {"name": "기관명", "addr": "주소", "tel": "전화번호"},
    "school": {"name": "schoolName", "addr": "adres"},
    "town_hall": {"name": "flctNm", "addr": "lctnRoadNmAddr", "tel": "telno", "lat": "lat", "lon": "lot"},
    "hospital": {"name": "dutyName", "addr": "dutyAddr", "tel": "dutyTel1", "lat": "wgs84Lat", "lon": "wgs84Lon"},
}
