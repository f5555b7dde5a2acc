"""Warehouse models over staging tables derived from the driver tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import NULL_MARK
from ..plans import contracts, dims, facts  # noqa: F401 - they fill MODELS
from ..plans.base import MODELS, Models
from ..plans.materialise import StoredModels, keep
from ..session import scratch_dir
from ..sinks.warehouse import Warehouse
from .base import Tables, query
from .staging_tables import STAGING

AS_OF = dt.date(2001, 8, 2)
REVIEWER = "U7"  # the reviewer whose rating is the internal score in this data
_DRIVER = "region nation customer supplier part orders lineitem".split()


def models_over(t: Tables, stored: bool = False, temporary: bool = False) -> Models:
    """Models over the staging tables; ``stored`` ones are built once and read back, ``temporary`` tables go after their last use."""
    views: set[str] = set()

    def staging(name: str) -> DataFrame:
        text = STAGING[name]
        for table in _DRIVER:
            if f"from {table}" in text:
                if table not in views:
                    getattr(t, table).createOrReplaceTempView(f"driver_{table}")
                    views.add(table)
                text = text.replace(f"from {table}", f"from driver_{table}")
        return t.spark.sql(text)

    if stored:
        return StoredModels(Warehouse(t.spark, scratch_dir(t.spark, "models"), buckets=8), staging, AS_OF, REVIEWER, temporary)
    return Models(staging, AS_OF, REVIEWER)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, ints as bigints, for comparison."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = (F.round(c, 10).cast("double") if f.dataType.scale > 6 else F.round(c.cast("double"), 4)).alias(f.name)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint").alias(f.name)
        out.append(c)
    return df.select(*out)


# -- the SQL side


def key(*columns: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(({c})::varchar, '{NULL_MARK}')" for c in columns) + ")"


def fill(c: str) -> str:
    return f"nullif(trim(({c})::varchar), '')"


def num(c: str) -> str:
    return f"round(({c})::double, 4)"


def ratio(top: str, bottom: str) -> str:
    """A whole number over another, half up to 12 and then to 10 digits, without floating point."""
    twelve = f"((({top})::hugeint * 2000000000000 + ({bottom})) // (2 * nullif({bottom}, 0)))"
    return f"(({twelve} + 50) // 100)::double / 10000000000"


def fields(pairs: dict[str, str]) -> str:
    return ", ".join(f'{fill(source)} as "{name}"' for name, source in pairs.items())


ORACLE: dict[str, str] = {}


def _staged(text: str) -> list[str]:
    named = set(re.findall(r"\bstg_(\w+)", text))
    return [n for n in STAGING if n in named]


def _with(body: str, *refs: str) -> str:
    """Put the staging tables (``stg_x``) and the models (``ref_x``) a text needs in front of it."""
    parts, text = [], body
    for name in refs:
        text += ORACLE[name]
    parts += [f"stg_{n} as ({STAGING[n].replace('`', chr(34))})" for n in _staged(text)]
    parts += [f"ref_{n} as ({ORACLE[n]})" for n in refs]
    return "with " + ", ".join(parts) + " " + body


def _register(number: str, name: str, body: str, *refs: str) -> None:
    ORACLE[name] = body
    fn = lambda t: _plain(MODELS[name](models_over(t, stored=bool(refs))))
    query(f"{number}_{name}", _with(body, *refs))(fn)


def _renamed(number, name, table, sk, pairs, where=""):
    _register(number, name, f"select {key(sk)} as {name}_sk, {fields(pairs)} from stg_{table} {where}")


_renamed("dim_01", "dim_ar", "hr_employee", "id", {"mã a&r": "id", "tên a&r": "name"})
_renamed("dim_02", "dim_artist", "res_partner", "id", {"platform_id": "id", "platform_name": "name"})
_register(
    "dim_03",
    "dim_artist_distro",
    f"select distinct {key('\"idArtist\"')} as dim_artist_distro_sk, {fields({'artist_id': '"idArtist"', 'artist_name': '"mainArtist"'})} "
    f"from stg_stream_distro where {fill('\"idArtist\"')} is not null",
)
_register(
    "dim_04",
    "dim_channel",
    f"""
    select {key('"YoutubeChannelId"')} as dim_channel_sk,
           {fields({'channel_id': '"YoutubeChannelId"', 'channel_name': 'c."Title"', 'company_id': '"CompanyId"', 'employee_name': '"FullName"',
                    'project_id': '"ProjectId"', 'sub_project_id': '"ParentId"', 'link': 'c."Description"', 'network_id': 'n."Id"'})}
    from stg_channel c
    left join stg_channel_project cp on cp."ChannelId" = c."Id"
    left join stg_project p on p."Id" = cp."ProjectId"
    left join (select "ChannelId", "FullName" from (
                   select *, row_number() over (partition by "ChannelId" order by "CreatedTimeUtc" desc nulls first, "UserId") as place
                   from stg_channel_user where not "IsDeleted") left join stg_user on "Id" = "UserId" where place = 1) u on u."ChannelId" = c."Id"
    left join (select * from stg_channel_deal where not "IsDeleted" and not "IsOutNet") d on d."ChannelId" = c."Id"
    left join stg_cms m on m."Id" = d."CmsId"
    left join stg_network n on n."Id" = m."NetworkId"
    """,
)
_renamed("dim_05", "dim_company", "res_company", "id", {"company_id": "id", "company_name": "name"})
_renamed("dim_06", "dim_company_stock", "company", '"Id"', {"company_id": '"Id"', "company_name": '"Name"'})
_LOCAL = "coalesce({0} ->> '$.vi_VN', {0} ->> '$.en_US')"
_renamed("dim_07", "dim_department", "hr_department", "id", {"department_id": "id", "company_id": "company_id", "department_name": _LOCAL.format("name")})
_register(
    "dim_08",
    "dim_distributed_employee",
    f"select {key('\"Id\"')} as dim_distributed_employee_sk, {fields({'emp_id': '"Id"', 'emp_name': '"DisplayName"'})}, "
    "null::varchar as department_id, null::varchar as team, null::varchar as role from stg_users ",
)
_register(
    "dim_09",
    "dim_editing",
    f"""
    select distinct {key('"EditingFileId"')} as dim_editing_sk, {fields({'editing_code': '"EditingFileId"', 'editing_name': '"Title"'})},
           nullif("EditingSoftware", '') as software, cast("CreatedDate" as timestamp) as date
    from stg_editings where trim("EditingFileId") <> ''
    """,
)
_renamed(
    "dim_11",
    "dim_khsx",
    "x_music_plan",
    "id",
    {"production_plan_id": "id", "plan_name": "name", "created_date": "create_date", "production_month": "date", "status": "state", "created_by": "create_uid"},
)
_renamed("dim_12", "dim_net", "network", '"Id"', {"net_id": '"Id"', "net_name": '"Name"'})
_register(
    "dim_13",
    "dim_order_employee",
    f"""
    select {key('e.id')} as dim_order_employee_sk, {fields({'order_employee_id': 'e.id', 'department_id': 'd.id', 'employee_name': 'e.name', 'position': _LOCAL.format('j.name')})},
           null::varchar as team_name
    from stg_hr_employee e left join stg_hr_department d on d.id = e.department_id left join stg_hr_job j on j.id = e.job_id
    """,
)
_register(
    "dim_14",
    "dim_partners",
    f"select distinct {key('\"Tên đối tác\"')} as partner_id, {fill('\"Tên đối tác\"')} as partner_name from stg_partners where trim(\"Tên đối tác\") <> ''",
)
_register(
    "dim_15",
    "dim_platform",
    f"select distinct {key('retailer')} as dim_platform_sk, {key('retailer')} as artist_id, {fill('retailer')} as artist_name from stg_sale where trim(retailer) <> ''",
)
_register(
    "dim_16",
    "dim_po",
    f"""
    select {key('id')} as dim_po_sk, {fields({'po_id': 'id', 'order_employee_id': 'x_employee_id', 'ordering_company': 'company_id', 'status': 'state'})},
           create_date as po_created_date, cast({fill('date_approve')} as timestamp) as po_confirmed_date from stg_purchase_order
    """,
)
_renamed("dim_17", "dim_project", "x_project", "id", {"project_id": "id", "project_name": "name", "status": "state"})
_renamed("dim_18", "dim_project_stock", "project", '"Id"', {"project_id": '"Id"', "project_name": '"ProjectName"'}, 'where "ParentId" is null')
_register(
    "dim_19",
    "dim_purchased_resource",
    f"""
    select distinct on ("Mã") {key('"Mã"')} as dim_purchased_resource_sk,
           {fields({'hg_stock_id': '"Mã"', 'resources_name': '"Tiêu đề"', 'repository': '"Repository"', 'buy_date': '"Ngày ký HĐ"', 'repository_type': '"Cách tính giá"'})},
           {key('"Nghệ sĩ bài hát"')} as partner_id
    from stg_purchased_resource left join stg_partners on trim("Tên kho trên HG Stock") = trim("Repository")
    where regexp_full_match(trim("Mã"), 'HG[A-F0-9]+')
    order by "Mã", "Tiêu đề" nulls last, "Nghệ sĩ bài hát" nulls last, "Repository" nulls last, "Ngày ký HĐ" nulls last, "Cách tính giá" nulls last
    """,
)
_renamed(
    "dim_20", "dim_repository", "x_product_subgenre", "id",
    {"repository_id": "id", "sub_project_id": "product_genre_id", "repository_name": "name"}, "where product_genre_id is not null",
)
_register(
    "dim_21",
    "dim_resource",
    f"""
    select {key('id')} as dim_resource_sk, {fields({'resource_id': 'id', 'repository_id': 'subgenre_id', 'resource_name': 'song_name', 'song_code': 'name',
           'production_plan_detail_id': 'detail_line_id', 'so_id': 'sale_order_id', 'po_detail_id': 'purchase_order_line_id'})},
           {num(f"cast({fill('review_score')} as decimal(18,2))")} as acceptance_score, {num('review_price')} as acceptance_cost, review_date as acceptance_date,
           case state when 'draft' then 'Đang sản xuất' when 'approved' then if(produce_state = 6, 'Không nghiệm thu', 'Đã nghiệm thu') end as status
    from stg_x_music_song
    """,
)
_register(
    "dim_22",
    "dim_resource_before_odoo",
    f"""
    select distinct on (trim("ISRC")) {key('"ISRC"')} as dim_resource_before_odoo_sk,
           {fields({'isrc': '"ISRC"', 'resource_name': '"Mã bài"', 'ar': '"A&R phụ trách"', 'artist': '"Nghệ sỹ"'})},
           {num(f"try_cast({fill('\"Điểm trung bình\"')} as decimal(18,2))")} as aceptance_score, {num(f"try_cast({fill('\"Chi phí đv: $\"')} as decimal(18,2))")} as aceptance_price
    from stg_resource_before_odoo where trim("ISRC") not in ('', '#N/A', '#REF!')
    order by trim("ISRC"), "ISRC", "Mã bài", "Điểm trung bình"
    """,
)
_register(
    "dim_23",
    "dim_so",
    f"select {key('id')} as dim_so_sk, {fields({'so_id': 'id', 'po_id': 'x_purchase_line_id', 'status': 'state'})}, create_date as so_created_date, write_date as so_confirmed_date from stg_sale_order_line ",
)
_renamed(
    "dim_25", "dim_sub_project", "x_product_genre", "id",
    {"sub_project_id": "id", "project_id": "project_id", "sub_project_name": "name", "description": "description"},
)
_renamed("dim_26", "dim_subproject_stock", "project", '"Id"', {"sub_project_id": '"Id"', "sub_project_name": '"ProjectName"'}, 'where "ParentId" is not null')
_register("dim_27", "dim_usd", "select record_date::date as record_date, exchange_rate from stg_usd_rate ")
_register(
    "dim_28",
    "dim_video",
    f"""
    select {key('"YoutubeVideoId"')} as dim_video_sk, {fields({'video_id': '"YoutubeVideoId"', 'channel_id': '"YoutubeChannelId"', 'video_name': '"Title"'})},
           concat('https://www.youtube.com/watch?v=', "YoutubeVideoId") as video_url, "PublishedAt"::timestamp as published_date
    from stg_channel_video_info where trim("YoutubeVideoId") <> ''
    """,
)
_register(
    "fct_01",
    "bridge_bt_vid",
    f"""
    select {key('"YoutubeVideoId"', 'editing_code')} as bridge_bt_vid_sk, editing_code, {fill('"YoutubeVideoId"')} as video_id
    from (select *, regexp_extract("Description", 'HG[A-Z0-9]{{30,34}}') as editing_code from stg_channel_video_info) where editing_code <> ''
    """,
)
_register(
    "fct_02",
    "fact_artist_assignment",
    f"""
    select {key('x.id')} as fact_artist_assignment_sk, {fields({'production_plan_detail_id': 'detail_id', 'artist_id': 'partner_id', 'artist_name': 'p.name'})}
    from stg_x_music_plan_detail_price x left join stg_res_partner p on p.id = partner_id
    """,
)


def _names(cell: str, table: str, name: str) -> str:
    return f"""(select string_agg("{name}", ', ' order by place, "{name}") from
        (select trim(item) as item, place from unnest(string_split({cell}, ',')) with ordinality as u(item, place)) join stg_{table} on item = "Id"::varchar)"""


_register(
    "fct_03",
    "fact_distribution",
    f"""
    select {key('d."Id"')} as fact_distribution_sk, d."Id" as distribution_id, f."ResourceFileId" as hg_stock_id, d."CreatedDate" as distribution_date,
           'Dùng chung' as recipient_company, {_names('d."DepartmentData"', 'department', 'Name')} as department,
           {_names('d."GroupData"', 'groups', 'Name')} as team, {_names('d."UserData"', 'users', 'DisplayName')} as employee, d."CreatedByUserId" as distributed_employee_id
    from stg_distribution_media_history d left join stg_resource_file_info f on f."Id" = d."ResourceFileInfoId"
    """,
)
_register(
    "fct_04",
    "fact_editing",
    f"""
    select {key('u."Id"')} as fact_editing_sk, e."Id" as editing_id, "EditingFileId" as editing_code, "ResourceFileId" as hg_stock_id,
           row_number() over (partition by u."EditingId" order by "StartTime", u."Id") as position, {num('"EndTime" - "StartTime"')} as duration
    from stg_resource_editings u, stg_editings e, stg_resource r
    where e."Id" = u."EditingId" and r."Id" = u."ResourcesId" and r."ResourceType" = 0 and starts_with(r."ResourceFileId", 'HGFA')
    """,
)
_register(
    "fct_05",
    "fact_evaluation_assignment",
    f"""
    select {key('r."Id"')} as music_evaluation_id, {fields({'reviewer_id': '"CreatedByUserId"', 'reviewer_name': '"FullName"'})}, {num('"Rating"')} as score
    from stg_review r left join stg_review_user u on u."Id" = r."CreatedByUserId"
    """,
)
_register(
    "fct_06",
    "fact_khsx_detail",
    f"select {key('id')} as fact_khsx_detail_sk, {fields({'production_plan_detail_id': 'id', 'production_plan_id': 'plan_id', 'production_manager': 'produce_manager', 'ar_manager': 'ar_id', 'status': 'state'})} from stg_x_music_plan_detail ",
)
_register(
    "fct_07",
    "fact_label_operation",
    f"""
    , best as (select isrc as code, min(id) as lowest from stg_x_music_song where active and trim(isrc) <> '' group by 1)
    select {key('id')} as fact_label_operation_sk, {fields({'resource_id': 'id', 'release_status': 'release_state', 'acceptance_url': 'acceptance_link', 'isrc': 'isrc', 'distributor': 'distro'})},
           release_date::timestamp as release_date
    from best join stg_x_music_song s on s.id = lowest left join stg_x_acceptance_cert a on a.purchase_order_id::bigint = s.purchase_order_id
    """,
)
_register(
    "fct_08",
    "fact_music_evaluation",
    f"""
    select {key('r."Id"')} as music_evaluation_id, "SongCode" as resource_id, version_no as version, {num("case when r.\"CreatedByUserId\" = 'U7' then \"Rating\" end")} as internal_score,
           {num('market')} as marketing_score, r."Concluding" as status, if("Comment"[1] = '{{', "Comment" ->> '$.Comment', "Comment") as comment, r."CreatedDate" as review_date
    from stg_review r
    left join (select *, row_number() over (partition by "RecordingSoundId" order by "CreatedDate", "Id") as version_no from stg_recording_sound_version) v on v."Id" = r."RecordingSoundVersionId"
    left join stg_recording_sound s on s."Id" = v."RecordingSoundId"
    left join (select "RecordingSoundVersionId" as rated, round(avg("Rating"), 6) as market from stg_user_comment_version join stg_version_needs_comment n on n."Id" = "VersionNeedsCommentId" group by 1) k
      on rated = r."RecordingSoundVersionId"
    """,
)
_register(
    "fct_09",
    "fact_po_detail",
    f"select {key('id')} as fact_po_detail_sk, {fields({'po_detail_id': 'id', 'po_id': 'order_id', 'qty_order': 'product_qty', 'repository': 'x_subgenre_id'})} from stg_purchase_order_line ",
)
_DIGITS = "nullif(regexp_replace({}, '[^0-9]', '', 'g'), '')::bigint"
_register(
    "fct_10",
    "fact_purchase_cost",
    f"""
    , months as (unpivot (select trim("Tên đối tác") as partner, "_year" as y, {_DIGITS.format('"Total năm"')} as total,
                           {", ".join(f'{_DIGITS.format(chr(34) + f"CP tháng {n}" + chr(34))} as "{n}"' for n in range(1, 13))} from stg_purchase_cost)
                  on {", ".join(f'"{n}"' for n in range(1, 13))} into name month_no value cost),
    stores as (select distinct trim("Tên đối tác") as partner, trim("Tên kho trên HG Stock") as store from stg_partners where trim("Tên kho trên HG Stock") <> ''),
    sized as (select *, count(*) over (partition by repository) as n from ref_dim_purchased_resource)
    select {key('hg_stock_id', 'y', 'month_no')} as cost_id, hg_stock_id as resource_id, {ratio('total', 'n')} as total_cost, {ratio('cost', 'n')} as additional_cost,
           last_day(make_date(y::int, month_no::int, 1)) as incurred_datetime
    from months join stores using (partner) join sized on repository = store
    """,
    "dim_purchased_resource",
)


def _members(condition: str) -> str:
    return f"""(select "YoutubeChannelId" from stg_channel where "SuspendedTimeUtc" is null
        and "Id" in (select "ChannelId" from stg_channel_deal where not "IsOutNet" and not "IsDeleted" and {condition})
        and "Id" in (select "ChannelId" from stg_channel_company where "Type" is null))"""


def _figures(condition: str) -> str:
    return f"""(select m.* from stg_channel_video_metric m join stg_channel_video_info v on v."YoutubeVideoId" = m."YoutubeVideoId"
        where v."YoutubeChannelId" in {_members(condition)} and m."Date" is not null)"""


_USD = "(select record_date::date as day, min(exchange_rate) as exchange_rate from stg_usd_rate group by 1)"
_register(
    "fct_11",
    "fact_revenue_by_resources",
    f"""
    , uses as (select video_id, editing_code, hg_stock_id, row_number() over w as rn, count(*) over (partition by video_id, editing_code) as n
               from ref_bridge_bt_vid join ref_fact_editing using (editing_code) window w as (partition by video_id, editing_code order by position, hg_stock_id)),
    credit as (select *, list_value([10], [7, 3], [6, 3, 1], [6, 2, 1, 1], [5, 2, 1, 1, 1])[least(n, 5)][rn] as w from uses where rn <= 5)
    select {key('video_id', 'hg_stock_id', '"Date"')} as revenue_id, video_id, hg_stock_id as resource_id, {num('"EstimatedRevenue"::decimal(18,2) * w / 10.0')} as revenue_amount,
           "Date"::timestamp as recorded_date, {num('"Views"::bigint * w / 10.0')} as "view", exchange_rate
    from credit join {_figures('"ReceiveTimeUtc" is not null')} on "YoutubeVideoId" = video_id left join {_USD} on day = "Date"::date
    """,
    "bridge_bt_vid",
    "fact_editing",
)
_register(
    "fct_12",
    "fact_revenue_distro",
    f"""
    select {key('retailer', 'isrc', 'revenue_month')} as fact_revenue_distro_sk, {num('revenue')} as revenue_amount, revenue_month, {fill('retailer')} as platform, isrc, artist, exchange_rate
    from (select retailer, "iSRC" as isrc, {fill('artist')} as artist, substr("reportingPeriod", 1, 7) as revenue_month, min("reportingPeriod"::date) as first_day,
                 sum(replace(earnings, ',', '')::decimal(18,2)) as revenue from stg_sale where trim("iSRC") <> '' group by all)
    left join {_USD} on day = first_day
    """,
)
_register(
    "dim_10",
    "dim_isrc",
    f"""
    , pairs as (select distinct "ResourceFileId" as f, "ISRC" as i from stg_resource_file_info where trim("ISRC") <> ''),
    ranked as (select *, row_number() over (partition by f order by i) as a, row_number() over (partition by i order by f) as b from pairs)
    select {key('f', 'i')} as dim_isrc_sk, {fill('f')} as hg_stock_id, {fill('i')} as isrc from ranked
    where a = 1 and b = 1 and trim(i) in (select isrc from ref_fact_revenue_distro)
    """,
    "fact_revenue_distro",
)
_register(
    "fct_13",
    "fact_revenue_yt",
    f"""
    select {key('"YoutubeVideoId"', '"Date"')} as fact_revenue_yt_sk, "YoutubeVideoId" as video_id, {num('"EstimatedRevenue"')} as revenue_amount, "Date"::timestamp as revenue_date, exchange_rate
    from {_figures('"ReceiveTimeUtc" is not null')} left join {_USD} on day = "Date"::date
    """,
)
_register(
    "fct_14",
    "fact_so_detail",
    f"""
    select {key('id')} as fact_so_detail_sk, {fields({'so_detail_id': 'id', 'so_id': 'order_id', 'repository': 'x_subgenre_id', 'deadline': 'x_deadline'})},
           {num('product_uom_qty')} as song_qty, {num(f"{fill('x_expected_score')}::decimal(18,2)")} as expected_score, {num('x_produce_qty')} as production_qty, {num('x_qty_in_stock')} as pending_qty
    from stg_sale_order_line
    """,
)
_register(
    "fct_15",
    "fact_view_stream_distro",
    f"""
    select {key('s.isrc', '"reportingDate"', '"idArtist"')} as fact_view_stream_distro_sk, {num("replace(\"dailyStream\", ',', '')")} as stream_count, {fill('"reportingDate"')}::date as recorded_date,
           {fields({'platform': 'p.retailer', 'isrc': 's.isrc', 'artist': '"idArtist"'})}
    from stg_stream_distro s left join (select distinct "iSRC" as code, retailer from stg_sale where trim("iSRC") <> '') p on trim(code) = trim(s.isrc) where trim(s.isrc) <> ''
    """,
)
_register(
    "fct_16",
    "fact_view_yt",
    f"""
    select {key('"YoutubeVideoId"', '"Date"')} as fact_view_yt_sk, "YoutubeVideoId" as video_id, {num('"Views"')} as view_count, "Date"::timestamp as recorded_date,
           {ratio('"EstimatedRevenue"::decimal(18,2) * 100', '"Views"::bigint * 100')} as rpm
    from {_figures('"OutNetTimeUtc" is null')}
    """,
)
_register(
    "fct_17",
    "fact_youtube_operation",
    f"""
    select distinct on (hg_stock_id) {key('hg_stock_id')} as fact_youtube_operation_sk, hg_stock_id, isrc, cid, net, stock_url, submitted_date
    from (select coalesce({fill('hg_code')}, {fill('"ResourceFileId"')}) as hg_stock_id, s.isrc, cid_state as cid, net_cid as net, hg_link as stock_url, ytb_sent_date as submitted_date
          from stg_x_music_song s left join stg_resource_file_info f on trim(f."ISRC") = s.isrc where trim(s.isrc) <> '')
    where hg_stock_id is not null
    order by hg_stock_id, isrc, cid, net, stock_url, submitted_date nulls last
    """,
)
_register(
    "dim_24",
    "dim_stock",
    f"""
    , files as (select {fill('"ResourceFileId"')} as stock, "Title" as title, {fill('"ISRC"')} as code, "CreatedDate" as created,
                       case when "Title" ilike '%.wav' or "Title" is null then 1 else 0 end as late from stg_resource_file_info where trim("ResourceFileId") <> ''),
    once as (select distinct on (stock) * from files order by stock, late, created, title nulls last, code nulls last),
    twice as (select distinct on (code) * from once order by code nulls last, late, created, title nulls last, stock),
    shown as (select f.hg_stock_id as stock, max(v.published_date::date) as newest from ref_fact_editing f join ref_bridge_bt_vid using (editing_code) join ref_dim_video v using (video_id) group by 1)
    select {key('t.stock')} as dim_stock_sk, t.stock as hg_stock_id, {fill('title')} as name, code as isrc, created as stock_stored_date,
           date_diff('day', created::date, date '2001-08-02') as resource_age_days,
           case when t.stock in (select "ResourceFileInfoId" from stg_resource_storage_history where "ToStatus" = 'Archived') then 'Lưu kho'
                when s.stock is null then 'Tồn kho' when newest < date '2001-07-03' then 'Hàng nguội' else 'Sử dụng' end as status
    from twice t left join shown s on s.stock = t.stock
    """,
    "fact_editing",
    "bridge_bt_vid",
    "dim_video",
)

assert set(ORACLE) == set(MODELS), set(MODELS) ^ set(ORACLE)


# -- contracts over the built models


def _closure(*names: str) -> list[str]:
    """Models in an order where each comes after those it reads."""
    out: list[str] = []

    def add(name: str) -> None:
        for other in re.findall(r"\bref_(\w+)", ORACLE[name]):
            add(other)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


def _nested(name: str) -> str:
    """A model's SQL as a CTE body; texts that start with further CTEs get their WITH."""
    body = ORACLE[name].strip()
    return "with " + body[1:] if body.startswith(",") else body


def _report(parts: list[str], names: list[str]) -> str:
    used = _closure(*names)
    staged = _staged(" ".join(ORACLE[n] for n in used))
    ctes = [f"stg_{n} as ({STAGING[n].replace('`', chr(34))})" for n in staged]
    ctes += [f"ref_{n} as ({_nested(n)})" for n in used]
    return "with " + ", ".join(ctes) + " " + " union all ".join(parts)


_KEY_PARTS = []
for _name in contracts.KEYED:
    _KEY_PARTS.append(
        f"select '{_name}' as model, 'unique' as check_name, (select count(*) from (select {_name}_sk from ref_{_name} group by 1 having count(*) > 1)) as failures"
    )
    _KEY_PARTS.append(f"select '{_name}', 'not_null', (select count(*) from ref_{_name} where {_name}_sk is null)")


@query("dq_24_model_keys", _report(_KEY_PARTS, contracts.KEYED))
def dq_24(t):
    return contracts.key_report(models_over(t, stored=True, temporary=True))


_REF_PARTS = [
    f"select '{a}' as model, '{c}_in_{b}' as check_name, (select count(*) from ref_{a} where {c} is not null and {c} not in (select {f} from ref_{b} where {f} is not null)) as failures"
    for a, c, b, f in contracts.REFERENCES
]


@query("dq_04_model_references", _report(_REF_PARTS, [n for a, _, b, _ in contracts.REFERENCES for n in (a, b)]))
def dq_04_models(t):
    return contracts.reference_report(models_over(t, stored=True))


_LOST_PARTS = [
    f"select '{t}' as staging, '{c}' as column_name, count(*) as failures from stg_{t} where {fill(chr(34) + c + chr(34))} is not null and try_cast({fill(chr(34) + c + chr(34))} as {kind}) is null"
    for t, c, kind in contracts.TYPED
]


@query("dq_24_lost_values", _with(" union all ".join(_LOST_PARTS)))
def dq_24_lost(t):
    """Texts that models cannot read as the type they give them."""
    return contracts.lost_value_report(models_over(t))


@query(
    "snk_08_shared_keys",
    _with(
        "select fact_revenue_distro_sk, revenue_amount, revenue_month, platform, isrc, artist, exchange_rate from ref_fact_revenue_distro",
        "fact_revenue_distro",
    ),
)
def snk_08_shared(t):
    """A fact whose rows share keys, loaded in two parts, equals the whole."""
    m = models_over(t)
    whole = m.ref("fact_revenue_distro")
    wh = Warehouse(t.spark, scratch_dir(t.spark, "fact"), buckets=8)
    keep(wh, "fact_revenue_distro", whole.where("revenue_month < '1996-01'"))
    return _plain(keep(wh, "fact_revenue_distro", whole))
