"""Business names the reports depend on. Brand and group names are arguments and have no default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Fixed values of the CRM: form keys and the kind of form they stand for.
FORM_KINDS = {"7ErjR9Pu": "Offline", "epo32S8g": "Online", "MIVvHNoV": "Daily report"}
VISIT_FORMS = ("7ErjR9Pu", "epo32S8g")
DAILY_FORM = "MIVvHNoV"

# Form attributes.
DATE_OF_VISIT = "Date of Visit"
DATE_OF_REPORT = "Date of Report"
MEETING_AMOUNT = "Order Amount Confirmed in the Meeting (CNY)"

# User selection and region order of the CRM reports.
SALES_DEPARTMENT = "海外营销中心"
SALES_POSTS = ("Sales", "Sales Support", "Sales Manager", "Leader")
LARGE_REGIONS = ("北美大区", "欧洲大区")

# Order of the sales regions in the customer report.
SALES_REGIONS = (
    "美中区域", "美东区域", "美西区域", "加拿大区域", "英国区域", "法国区域", "意大利区域", "德国区域", "俄罗斯区域",
    "马来区域", "印尼区域", "菲律宾区域", "新兴贸易区域", "澳新区域", "内贸区域", "中东非区域", "电商部", "未分配区域",
)
NO_REGION = "未分配区域"

# Linked workbooks and the titles of their sheets.
VISIT_BOOK, VISIT_TITLE = "引用附件勿删BF.xlsx", "拜访"
DAILY_BOOK, DAILY_TITLE = "引用附件勿删RB.xlsx", "工作日报"
BACK_LINK = (
    '=HYPERLINK("[销售跟进情况汇总（月）"&TEXT(TODAY()-1,"yyyy-mm-dd")&".xlsx]\'销售跟进情况汇总（月）\'!N2",'
    '"<< 返回跟进情况页")'
)

# Work centres of the shelf-life report.
WORK_CENTRES = (
    "1102", "1103", "1104", "1105", "1201", "1203", "1204", "1205", "1206", "1302", "1303", "1304", "1801", "1902",
)

# Fixed values of the daily KPI report: factories, and the subject behind each series.
FACTORIES = {"sg": "松岗", "lb": "寮步", "dls": "大岭山", "wx": "外协"}
PLANTS = ("sg", "lb", "dls")
PLANT_SUBJECTS = {
    "rjcz": "人均产值",
    "gcrs": "工厂人数",
    "scxl": "综合生产效率",
    "ssgs": "损失工时",
    "gcjdl": "工厂稼动率",
    "wlqtl": "12H物料齐套率",
    "pzycgbl": "品质异常关闭率",
    "jhbdl": "72小时内计划变动率",
    "iqc": "IQC来料检验合格率-量产",
    "mdcshgl": "盲点测试合格率",
    "zchgl": "制程合格率",
    "fqc": "FQC批次合格率",
}


@dataclass(frozen=True)
class DailyKpiNames:
    """`groups` and `product_lines` map the short name used in slice ids to the value in the data."""

    groups: Mapping[str, str]
    product_lines: Mapping[str, str]
    categories: Mapping[str, str] = field(default_factory=lambda: {"host": "主机", "part": "耗材"})
    left_out_of_backlog: str = "CBD"
    form_type: str = "日报"
    daily_output: str = "日产值"
    by_product_line: str = "by产品线"
    by_factory: str = "by工厂"
    factories: Mapping[str, str] = field(default_factory=lambda: dict(FACTORIES))
    plants: Sequence[str] = PLANTS
    plant_subjects: Mapping[str, str] = field(default_factory=lambda: dict(PLANT_SUBJECTS))
