"""Dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import age_days
from ..functions.keys import surrogate_key
from ..functions.text import blank_to_null, localised, prefer_unlike, typed
from ..operators.business import latest_per, usage_status
from ..operators.dedupe import deduplicate, deduplicate_twice, mutual_best
from .base import MODELS, MOMENT, MONEY, keyed, model, reads

# Dimensions that only rename: name, staging table, key column, output columns.
_RENAMED = [
    ("dim_ar", "hr_employee", "id", {"mã a&r": "id", "tên a&r": "name"}),
    ("dim_artist", "res_partner", "id", {"platform_id": "id", "platform_name": "name"}),
    ("dim_company", "res_company", "id", {"company_id": "id", "company_name": "name"}),
    ("dim_company_stock", "company", "Id", {"company_id": "Id", "company_name": "Name"}),
    (
        "dim_khsx",
        "x_music_plan",
        "id",
        {
            "production_plan_id": "id",
            "plan_name": "name",
            "created_date": "create_date",
            "production_month": "date",
            "status": "state",
            "created_by": "create_uid",
        },
    ),
    ("dim_net", "network", "Id", {"net_id": "Id", "net_name": "Name"}),
    ("dim_project", "x_project", "id", {"project_id": "id", "project_name": "name", "status": "state"}),
    (
        "dim_sub_project",
        "x_product_genre",
        "id",
        {"sub_project_id": "id", "project_id": "project_id", "sub_project_name": "name", "description": "description"},
    ),
]


def _renamed(name, table, key, fields):
    MODELS[name] = lambda m: keyed(m.staging(table), f"{name}_sk", key, fields)


for _row in _RENAMED:
    _renamed(*_row)


@model
def dim_artist_distro(m):
    rows = m.staging("stream_distro").where(blank_to_null("idArtist").isNotNull())
    rows = rows.dropDuplicates(["idArtist", "mainArtist"])
    return keyed(rows, "dim_artist_distro_sk", "idArtist", {"artist_id": "idArtist", "artist_name": "mainArtist"})


@model
def dim_platform(m):
    """Retailers; the key is repeated as ``artist_id`` and the name sits in ``artist_name``."""
    rows = m.staging("sale").where(blank_to_null("retailer").isNotNull()).dropDuplicates(["retailer"])
    return keyed(rows, "dim_platform_sk", "retailer", {"artist_id": surrogate_key("retailer"), "artist_name": "retailer"})


@model
def dim_channel(m):
    """One row per public channel with its project, newest user and active network."""
    users = m.staging("channel_user").where(~F.col("IsDeleted"))
    newest = latest_per(users, ["ChannelId"], "CreatedTimeUtc", F.asc_nulls_last("UserId"))
    names = m.staging("user").select(F.col("Id").alias("_user"), F.col("FullName").alias("_employee"))
    assigned = newest.join(names, F.col("UserId") == F.col("_user"), "left")
    assigned = assigned.select(F.col("ChannelId").alias("_assigned"), "_employee")

    deals = m.staging("channel_deal").where(~F.col("IsDeleted") & ~F.col("IsOutNet")).select("ChannelId", "CmsId")
    cms = m.staging("cms").select(F.col("Id").alias("_cms"), "NetworkId")
    networks = m.staging("network").select(F.col("Id").alias("_network"))
    member = deals.join(cms, F.col("CmsId") == F.col("_cms"), "left")
    member = member.join(networks, F.col("NetworkId") == F.col("_network"), "left")
    member = member.select(F.col("ChannelId").alias("_member"), "_network")

    links = m.staging("channel_project").select(F.col("ChannelId").alias("_linked"), "ProjectId")
    projects = m.staging("project").select(F.col("Id").alias("_project"), "CompanyId", "ParentId")
    rows = m.staging("channel").join(links, F.col("Id") == F.col("_linked"), "left")
    rows = rows.join(projects, F.col("ProjectId") == F.col("_project"), "left")
    rows = rows.join(assigned, F.col("Id") == F.col("_assigned"), "left")
    rows = rows.join(member, F.col("Id") == F.col("_member"), "left")
    total = ["Id", "ProjectId", "_employee", "_network", "Title", "Description"]
    rows = deduplicate(rows, ["YoutubeChannelId"], [F.asc_nulls_last(c) for c in total])
    return keyed(
        rows,
        "dim_channel_sk",
        "YoutubeChannelId",
        {
            "channel_id": "YoutubeChannelId",
            "channel_name": "Title",
            "company_id": "CompanyId",
            "employee_name": "_employee",
            "project_id": "ProjectId",
            "sub_project_id": "ParentId",
            "link": "Description",
            "network_id": "_network",
        },
    )


@model
def dim_department(m):
    name = blank_to_null(localised("name", "vi_VN", "en_US"))
    fields = {"department_id": "id", "company_id": "company_id", "department_name": name}
    return keyed(m.staging("hr_department"), "dim_department_sk", "id", fields)


@model
def dim_distributed_employee(m):
    """Department, team and role are not known to the sources yet."""
    unknown = F.lit(None).cast("string")
    fields = {"emp_id": "Id", "emp_name": "DisplayName", "department_id": unknown, "team": unknown, "role": unknown}
    return keyed(m.staging("users"), "dim_distributed_employee_sk", "Id", fields)


@model
def dim_editing(m):
    rows = m.staging("editings").where(blank_to_null("EditingFileId").isNotNull())
    rows = rows.dropDuplicates(["EditingFileId", "Title", "EditingSoftware", "CreatedDate"])
    return keyed(
        rows,
        "dim_editing_sk",
        "EditingFileId",
        {
            "editing_code": "EditingFileId",
            "editing_name": "Title",
            "software": F.nullif(F.col("EditingSoftware").cast("string"), F.lit("")),
            "date": typed("CreatedDate", MOMENT),
        },
    )


@reads("fact_revenue_distro")
@model
def dim_isrc(m):
    """Stock and recording code that are each other's first choice, for codes that earned."""
    filled = m.staging("resource_file_info").where(blank_to_null("ISRC").isNotNull())
    pairs = mutual_best(filled, "ResourceFileId", "ISRC")
    rows = keyed(pairs, "dim_isrc_sk", ["ResourceFileId", "ISRC"], {"hg_stock_id": "ResourceFileId", "isrc": "ISRC"})
    earning = m.ref("fact_revenue_distro").where(F.col("isrc").isNotNull()).select(F.col("isrc").alias("_earning"))
    return rows.join(earning, F.col("isrc") == F.col("_earning"), "left_semi")


@model
def dim_order_employee(m):
    departments = m.staging("hr_department").select(F.col("id").alias("_department"))
    jobs = m.staging("hr_job").select(F.col("id").alias("_job"), F.col("name").alias("_job_name"))
    rows = m.staging("hr_employee").join(departments, F.col("department_id") == F.col("_department"), "left")
    rows = rows.join(jobs, F.col("job_id") == F.col("_job"), "left")
    return keyed(
        rows,
        "dim_order_employee_sk",
        "id",
        {
            "order_employee_id": "id",
            "department_id": "_department",
            "employee_name": "name",
            "team_name": F.lit(None).cast("string"),
            "position": blank_to_null(localised("_job_name", "vi_VN", "en_US")),
        },
    )


@model
def dim_partners(m):
    rows = m.staging("partners").where(blank_to_null("Tên đối tác").isNotNull())
    return keyed(rows.dropDuplicates(["Tên đối tác"]), "partner_id", "Tên đối tác", {"partner_name": "Tên đối tác"})


@model
def dim_po(m):
    return keyed(
        m.staging("purchase_order"),
        "dim_po_sk",
        "id",
        {
            "po_id": "id",
            "po_created_date": typed("create_date", MOMENT),
            "order_employee_id": "x_employee_id",
            "ordering_company": "company_id",
            "status": "state",
            "po_confirmed_date": typed("date_approve", MOMENT),
        },
    )


@model
def dim_project_stock(m):
    """Main projects: those without a parent."""
    roots = m.staging("project").where(F.col("ParentId").isNull())
    return keyed(roots, "dim_project_stock_sk", "Id", {"project_id": "Id", "project_name": "ProjectName"})


@model
def dim_subproject_stock(m):
    children = m.staging("project").where(F.col("ParentId").isNotNull())
    return keyed(children, "dim_subproject_stock_sk", "Id", {"sub_project_id": "Id", "sub_project_name": "ProjectName"})


# Fixed value: form of a stock code.
STOCK_CODE = "^HG[A-F0-9]+$"


@model
def dim_purchased_resource(m):
    """Purchased recordings with a valid code and the contract of their repository."""
    contracts = m.staging("partners").select(
        F.trim("Tên kho trên HG Stock").alias("_repository"), F.col("Ngày ký HĐ").alias("_signed"), F.col("Cách tính giá").alias("_pricing")
    )
    rows = m.staging("purchased_resource").where(F.trim("Mã").rlike(STOCK_CODE))
    rows = rows.join(contracts, F.trim("Repository") == F.col("_repository"), "left")
    total = ["Tiêu đề", "Nghệ sĩ bài hát", "Repository", "_signed", "_pricing"]
    return keyed(
        deduplicate(rows, ["Mã"], [F.asc_nulls_last(c) for c in total]),
        "dim_purchased_resource_sk",
        "Mã",
        {
            "hg_stock_id": "Mã",
            "resources_name": "Tiêu đề",
            "repository": "Repository",
            "partner_id": surrogate_key("Nghệ sĩ bài hát"),
            "buy_date": "_signed",
            "repository_type": "_pricing",
        },
    )


@model
def dim_repository(m):
    rows = m.staging("x_product_subgenre").where(blank_to_null("product_genre_id").isNotNull())
    fields = {"repository_id": "id", "sub_project_id": "product_genre_id", "repository_name": "name"}
    return keyed(rows, "dim_repository_sk", "id", fields)


# Production states of an accepted song and the labels of its status.
REJECTED_STATE = 6
SONG_STATUS = {"rejected": "Không nghiệm thu", "accepted": "Đã nghiệm thu", "draft": "Đang sản xuất"}


@model
def dim_resource(m):
    approved, produced = F.col("state") == "approved", F.col("produce_state")
    status = (
        F.when(approved & (produced == REJECTED_STATE), SONG_STATUS["rejected"])
        .when(approved & (produced != REJECTED_STATE), SONG_STATUS["accepted"])
        .when(F.col("state") == "draft", SONG_STATUS["draft"])
    )
    return keyed(
        m.staging("x_music_song"),
        "dim_resource_sk",
        "id",
        {
            "resource_id": "id",
            "repository_id": "subgenre_id",
            "resource_name": "song_name",
            "song_code": "name",
            "acceptance_score": typed("review_score", MONEY),
            "acceptance_cost": typed("review_price", MONEY),
            "acceptance_date": typed("review_date", MOMENT),
            "production_plan_detail_id": "detail_line_id",
            "status": status,
            "so_id": "sale_order_id",
            "po_detail_id": "purchase_order_line_id",
        },
    )


# Spreadsheet error texts that are no recording code.
BROKEN_CELLS = ("#N/A", "#REF!")


@model
def dim_resource_before_odoo(m):
    code = blank_to_null("ISRC")
    rows = m.staging("resource_before_odoo").where(code.isNotNull() & ~code.isin(*BROKEN_CELLS)).withColumn("_code", code)
    total = ["ISRC", "Mã bài", "Điểm trung bình", "Chi phí đv: $", "A&R phụ trách", "Nghệ sỹ"]
    return keyed(
        deduplicate(rows, ["_code"], [F.asc_nulls_last(c) for c in total]),
        "dim_resource_before_odoo_sk",
        "ISRC",
        {
            "isrc": "ISRC",
            "resource_name": "Mã bài",
            "aceptance_score": typed("Điểm trung bình", MONEY),
            "aceptance_price": typed("Chi phí đv: $", MONEY),
            "ar": "A&R phụ trách",
            "artist": "Nghệ sỹ",
        },
    )


@model
def dim_so(m):
    return keyed(
        m.staging("sale_order_line"),
        "dim_so_sk",
        "id",
        {
            "so_id": "id",
            "po_id": "x_purchase_line_id",
            "so_created_date": typed("create_date", MOMENT),
            "so_confirmed_date": typed("write_date", MOMENT),
            "status": "state",
        },
    )


# Labels of a stock item's use, and the days after which an item is cold.
STOCK_STATUS = ("Lưu kho", "Tồn kho", "Hàng nguội", "Sử dụng")
COLD_DAYS = 30
ARCHIVED = "Archived"


@reads("bridge_bt_vid", "dim_video", "fact_editing")
@model
def dim_stock(m):
    """Stock items, one per id and per recording code, with age and use."""
    files = m.staging("resource_file_info").select(
        blank_to_null("ResourceFileId").alias("hg_stock_id"),
        F.col("Title").alias("_title"),
        blank_to_null("ISRC").alias("isrc"),
        F.col("CreatedDate").alias("_created"),
    )
    priority = [prefer_unlike("_title", "%.wav"), F.asc_nulls_last("_created")]
    total = [F.asc_nulls_last(c) for c in ("_title", "isrc", "hg_stock_id")]
    items = deduplicate_twice(files.where(F.col("hg_stock_id").isNotNull()), ["hg_stock_id"], ["isrc"], [*priority, *total])

    # Newest video date per editing first, so that the join to the edits stays narrow.
    videos = m.ref("dim_video").select("video_id", F.col("published_date").cast("date").alias("_published"))
    per_edit = m.ref("bridge_bt_vid").join(videos, "video_id").groupBy("editing_code").agg(F.max("_published").alias("_published"))
    # Uses that repeat change neither the newest date nor whether there is any, so they are not made distinct first.
    edits = m.ref("fact_editing").select("hg_stock_id", "editing_code")
    used = edits.join(per_edit.withColumn("_shown", F.lit(True)), "editing_code", "left").groupBy("hg_stock_id").agg(
        F.max("_published").alias("_last"), F.bool_or("_shown").alias("_shown")
    )
    used = used.select(F.col("hg_stock_id").alias("_used"), "_last", "_shown")
    archived = m.staging("resource_storage_history").where(F.col("ToStatus") == ARCHIVED)
    archived = archived.select(F.col("ResourceFileInfoId").alias("_archived")).distinct()

    rows = items.join(used, F.col("hg_stock_id") == F.col("_used"), "left")
    rows = rows.join(archived, F.col("hg_stock_id") == F.col("_archived"), "left")
    shown = F.coalesce("_shown", F.lit(False))
    # A shown item whose videos have no date counts as in use.
    last = F.when(shown, F.coalesce("_last", m.today))
    status = usage_status(F.col("_archived").isNotNull(), shown, last, m.today, STOCK_STATUS, COLD_DAYS)
    return keyed(
        rows,
        "dim_stock_sk",
        "hg_stock_id",
        {
            "hg_stock_id": F.col("hg_stock_id"),
            "name": "_title",
            "isrc": F.col("isrc"),
            "stock_stored_date": F.col("_created").cast(MOMENT),
            "resource_age_days": age_days("_created", m.today),
            "status": status,
        },
    )


@model
def dim_usd(m):
    rates = m.staging("usd_rate")
    return rates.select(F.col("record_date").cast("date").alias("record_date"), F.col("exchange_rate").cast("double"))


# Fixed value: address of a video.
WATCH_URL = "https://www.youtube.com/watch?v="


@model
def dim_video(m):
    rows = m.staging("channel_video_info").where(blank_to_null("YoutubeVideoId").isNotNull())
    return keyed(
        rows,
        "dim_video_sk",
        "YoutubeVideoId",
        {
            "video_id": "YoutubeVideoId",
            "channel_id": "YoutubeChannelId",
            "video_url": F.concat(F.lit(WATCH_URL), "YoutubeVideoId"),
            "published_date": typed("PublishedAt", MOMENT),
            "video_name": "Title",
        },
    )
