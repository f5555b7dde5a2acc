"""Staging tables of the models, derived from the driver tables.

One SELECT per staging table, plain enough to run on Spark and on the comparison
engine alike. Names in backticks keep their case.
"""

from __future__ import annotations

_MONTHS = ", ".join(
    f"case when s_nationkey % 6 = {n % 6} then ' ' else cast(cast(floor(s_acctbal) as bigint) + {n} as string) || ',000 usd' end as `CP tháng {n}`"
    for n in range(1, 13)
)
_AMOUNT = (
    "cast(cast(floor(l_extendedprice / 1000) as bigint) as string) || ',' || "
    "lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0') || '.25'"
)

STAGING = {
    "hr_employee": "select c_custkey as id, case when c_mktsegment = 'FURNITURE' then '  ' else ' ' || c_name end as name, "
    "c_nationkey as department_id, c_custkey % 7 as job_id from customer",
    "hr_department": "select n_nationkey as id, n_regionkey as company_id, case when n_regionkey = 1 "
    "then '{\"en_US\": \" ' || n_name || '\"}' else '{\"vi_VN\": \"Phòng ' || n_name || '\", \"en_US\": \"x\"}' end as name "
    "from nation where n_regionkey <> 2",
    "hr_job": "select r_regionkey as id, '{\"en_US\": \"' || r_name || '\"}' as name from region",
    "res_company": "select r_regionkey as id, ' ' || r_name as name from region",
    "res_partner": "select s_suppkey as id, case when s_acctbal < 0 then '' else s_name || ' ' end as name from supplier",
    "x_project": "select r_regionkey as id, r_name as name, case when r_name like 'A%' then 'open' else ' ' end as state from region",
    "x_product_genre": "select n_nationkey as id, n_regionkey as project_id, n_name as name, '' as description from nation",
    "x_product_subgenre": "select p_partkey as id, case when p_type <> 'SMALL' then p_size end as product_genre_id, p_name as name from part",
    "x_music_song": """
        select o_orderkey as id, o_custkey as subgenre_id, o_custkey + 5 as detail_line_id, o_custkey + 7 as sale_order_id,
               o_custkey as purchase_order_id, o_orderkey + 9 as purchase_order_line_id, o_orderpriority as song_name,
               'SONG' || cast(o_orderkey as string) as name,
               case o_orderstatus when 'F' then 'approved' when 'O' then 'draft' else 'cancelled' end as state,
               cast(month(o_orderdate) % 8 as int) as produce_state,
               case when o_orderpriority = '5-LOW' then ' ' else cast(cast(o_totalprice as decimal(18,2)) as string) end as review_score,
               cast(o_totalprice as decimal(18,2)) as review_price, o_orderdate as review_date,
               case when o_orderstatus = 'F' then 'HGFA' || cast(o_custkey as string) else '' end as hg_code,
               case when o_orderpriority = '3-MEDIUM' then ' ' else 'IS' || cast(o_custkey as string) end as isrc,
               'cid' || o_orderstatus as cid_state, 'net' || o_orderstatus as net_cid, 'http://stock/' || cast(o_orderkey as string) as hg_link,
               case when o_orderstatus = 'P' then null else o_orderpriority end as release_state, ' distro ' as distro,
               case when o_orderstatus = 'P' then null else o_orderdate + interval 2 day end as ytb_sent_date,
               cast(o_orderdate as string) as release_date, o_orderpriority <> '5-LOW' as active
        from orders""",
    "x_acceptance_cert": "select cast(c_custkey as string) as purchase_order_id, 'http://cert/' || c_name as acceptance_link from customer "
    "where c_mktsegment <> 'MACHINERY'",
    "x_music_plan": "select o_orderkey as id, o_custkey as create_uid, o_orderpriority as name, o_orderstatus as state, "
    "o_orderdate as create_date, cast(o_orderdate as date) as date from orders",
    "x_music_plan_detail": "select o_orderkey as id, o_custkey as plan_id, o_custkey + 1 as produce_manager, "
    "case when o_orderstatus = 'F' then o_custkey end as ar_id, o_orderstatus as state from orders",
    "x_music_plan_detail_price": "select o_orderkey as id, o_custkey as detail_id, o_custkey % 150 as partner_id from orders",
    "purchase_order": "select o_orderkey as id, o_custkey as x_employee_id, o_custkey % 5 as company_id, o_orderstatus as state, "
    "o_orderdate as create_date, case when o_orderstatus = 'F' then cast(o_orderdate as string) else ' ' end as date_approve from orders",
    "purchase_order_line": "select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as x_subgenre_id, "
    "cast(l_quantity as decimal(18,2)) as product_qty from lineitem",
    "sale_order_line": """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as x_subgenre_id, l_suppkey as x_purchase_line_id,
               cast(l_quantity as decimal(18,2)) as product_uom_qty, case when l_returnflag = 'A' then ' ' else '7.25' end as x_expected_score,
               cast(l_quantity as decimal(18,2)) as x_produce_qty, cast(l_discount as decimal(18,2)) as x_qty_in_stock,
               'day ' || l_returnflag as x_deadline, l_linestatus as state, l_shipdate as create_date,
               case when l_returnflag = 'R' then l_shipdate + interval 1 day end as write_date from lineitem""",
    "resource_file_info": """
        select 'RF' || cast(o_orderkey as string) as `Id`,
               case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then ' ' else 'HGFA' || cast(o_custkey as string) end as `ResourceFileId`,
               case when o_orderpriority = '1-URGENT' then 'take.WAV' when o_orderpriority = '2-HIGH' then null
                    else 'mix ' || cast(o_orderkey as string) || '.mp3' end as `Title`,
               case when o_orderstatus = 'O' then ' ' else 'IS' || cast(o_custkey as string) end as `ISRC`,
               o_orderdate as `CreatedDate` from orders""",
    "distribution_media_history": """
        select 'D' || cast(o_orderkey as string) as `Id`, case when o_orderstatus = 'P' then 'lost' else 'RF' || cast(o_orderkey as string) end as `ResourceFileInfoId`,
               'U' || cast(o_custkey as string) as `CreatedByUserId`,
               case o_orderpriority when '5-LOW' then '' when '1-URGENT' then null else cast(o_custkey % 25 as string) || ', 77, ' || cast(o_custkey % 4 as string) end as `DepartmentData`,
               cast(o_custkey % 5 as string) || ',,3' as `GroupData`, '9999' || case when o_orderstatus = 'F' then ', ' || cast(o_custkey % 60 as string) else '' end as `UserData`,
               o_orderdate as `CreatedDate` from orders""",
    "department": "select n_nationkey as `Id`, n_name as `Name` from nation",
    "groups": "select r_regionkey as `Id`, r_name as `Name` from region",
    "company": "select 'N' || cast(r_regionkey as string) as `Id`, r_name as `Name` from region",
    "network": "select 'N' || cast(r_regionkey as string) as `Id`, r_name as `Name` from region where r_name <> 'ASIA'",
    "users": "select s_suppkey as `Id`, s_name as `DisplayName` from supplier",
    "user": "select 'U' || cast(s_suppkey as string) as `Id`, ' ' || s_name as `FullName` from supplier",
    "review_user": "select 'U' || cast(s_suppkey as string) as `Id`, s_name as `FullName` from supplier where s_acctbal > 0",
    "resource_storage_history": "select 'HGFA' || cast(o_custkey as string) as `ResourceFileInfoId`, "
    "case when o_totalprice > 480000 then 'Archived' else 'Active' end as `ToStatus` from orders",
    "editings": """
        select 'ED' || cast(o_orderkey as string) as `Id`,
               case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then ' ' else 'HG' || upper(md5(cast(o_orderkey as string))) end as `EditingFileId`,
               'cut ' || o_orderpriority as `Title`, case when o_orderstatus = 'O' then '' else 'soft' end as `EditingSoftware`,
               cast(o_orderdate as string) as `CreatedDate` from orders""",
    "resource": "select 'RS' || cast(c_custkey as string) as `Id`, case when c_mktsegment = 'BUILDING' then 'XX' else 'HGFA' end || cast(c_custkey as string) as `ResourceFileId`, "
    "case when c_mktsegment = 'MACHINERY' then 1 else 0 end as `ResourceType` from customer",
    "resource_editings": """
        select 'RE' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
                    || '-' || cast(cast(l_extendedprice as decimal(18,2)) as string) as `Id`,
               'ED' || cast(l_orderkey as string) as `EditingId`, 'RS' || cast(l_partkey as string) as `ResourcesId`,
               l_linenumber as `StartTime`, l_linenumber + cast(l_quantity as int) as `EndTime` from lineitem""",
    "channel": """
        select 'CH' || cast(c_custkey as string) as `Id`, 'C' || cast(c_custkey as string) as `YoutubeChannelId`, c_name as `Title`,
               c_mktsegment as `Description`, case when c_mktsegment = 'FURNITURE' then '2020-01-01' end as `SuspendedTimeUtc` from customer""",
    "channel_project": "select 'CH' || cast(c_custkey as string) as `ChannelId`, 'P' || cast(c_nationkey as string) as `ProjectId` from customer where c_mktsegment <> 'HOUSEHOLD'",
    "project": "select 'P' || cast(n_nationkey as string) as `Id`, 'N' || cast(n_regionkey as string) as `CompanyId`, "
    "case when n_regionkey > 0 then 'P' || cast(n_regionkey as string) end as `ParentId`, n_name as `ProjectName` from nation",
    "channel_user": "select 'CH' || cast(o_custkey as string) as `ChannelId`, 'U' || cast(o_orderkey % 200 as string) as `UserId`, o_orderstatus = 'P' as `IsDeleted`, "
    "case when o_orderpriority <> '5-LOW' then o_orderdate end as `CreatedTimeUtc` from orders",
    "channel_deal": """
        select 'DL' || cast(c_custkey as string) as `Id`, 'CH' || cast(c_custkey as string) as `ChannelId`, 'CM' || cast(c_nationkey as string) as `CmsId`,
               c_acctbal < -500 as `IsDeleted`, c_acctbal > 9500 as `IsOutNet`, case when c_nationkey > 3 then '2020-01-01' end as `ReceiveTimeUtc`,
               case when c_acctbal > 7000 then '2021-01-01' end as `OutNetTimeUtc`, 1 as `Type` from customer""",
    "cms": "select 'CM' || cast(n_nationkey as string) as `Id`, 'N' || cast(n_regionkey as string) as `NetworkId`, false as `IsDeleted` from nation where n_regionkey <> 3",
    "channel_company": "select 'CH' || cast(c_custkey as string) as `ChannelId`, case when c_nationkey > 20 then 1 end as `Type` from customer",
    "channel_video_info": """
        select case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then ' ' else 'V' || cast(o_orderkey as string) end as `YoutubeVideoId`,
               'C' || cast(o_custkey as string) as `YoutubeChannelId`, ' ' || o_orderpriority as `Title`,
               case when o_orderpriority = '2-HIGH' then 'no code here' else 'made with HG' || upper(md5(cast(o_orderkey as string))) || ' and HG' || upper(md5(o_orderpriority)) end as `Description`,
               cast(o_orderdate as string) as `PublishedAt` from orders""",
    "channel_video_metric": """
        select case when l_returnflag = 'R' and l_linenumber = 7 then null else 'V' || cast(l_orderkey as string) end as `YoutubeVideoId`,
               substr(cast(l_shipdate as string), 1, 10) as `Date`, case when l_returnflag = 'A' then '0' else cast(cast(l_quantity as bigint) as string) end as `Views`,
               cast(cast(l_extendedprice as decimal(18,2)) as string) as `EstimatedRevenue` from lineitem""",
    "review": """
        select 'R' || cast(o_orderkey as string) as `Id`, 'U' || cast(o_custkey % 120 as string) as `CreatedByUserId`, 'RV' || cast(o_orderkey + 3 as string) as `RecordingSoundVersionId`,
               o_orderstatus as `Concluding`, cast(cast(o_totalprice as decimal(18,2)) as string) as `Rating`,
               case when o_orderpriority = '1-URGENT' then '{"Comment": "fine ' || o_orderstatus || '", "x": 1}' when o_orderpriority = '2-HIGH' then '{"Other": 1}'
                    when o_orderpriority = '5-LOW' then null else 'plain ' || o_orderpriority end as `Comment`, o_orderdate as `CreatedDate` from orders""",
    "recording_sound": "select 'SD' || cast(c_custkey as string) as `Id`, 'SONG' || cast(c_custkey as string) as `SongCode` from customer",
    "recording_sound_version": "select 'RV' || cast(o_orderkey as string) as `Id`, 'SD' || cast(o_custkey as string) as `RecordingSoundId`, o_orderdate as `CreatedDate` from orders",
    "version_needs_comment": "select 'VN' || cast(o_orderkey as string) as `Id`, 'RV' || cast(o_orderkey as string) as `RecordingSoundVersionId` from orders where o_orderstatus <> 'P'",
    "user_comment_version": "select 'VN' || cast(l_orderkey as string) as `VersionNeedsCommentId`, 'U' || cast(l_suppkey as string) as `UserId`, l_linenumber as `Rating` from lineitem",
    "partners": """
        select case when s_acctbal < -900 then ' ' else ' Partner ' || cast(cast(floor(s_suppkey / 4) as bigint) as string) || ' ' end as `Tên đối tác`,
               case when s_acctbal > 9000 then '' else 'Repo ' || cast(s_suppkey as string) || ' ' end as `Tên kho trên HG Stock`,
               'signed ' || cast(s_nationkey as string) as `Ngày ký HĐ`, 'fixed' as `Cách tính giá`, '2024' as `_year` from supplier""",
    "purchased_resource": """
        select case when p_type = 'SMALL' then ' not a code' else ' HG' || upper(substr(md5(cast(cast(floor(p_partkey / 2) as bigint) as string)), 1, 10)) end as `Mã`,
               p_name as `Tiêu đề`, p_brand as `Nghệ sĩ bài hát`, ' Repo ' || cast(cast(floor(p_partkey / 20) as bigint) as string) as `Repository` from part""",
    "purchase_cost": f"""
        select 'Partner ' || cast(cast(floor(s_suppkey / 4) as bigint) as string) as `Tên đối tác`, {_MONTHS},
               case when s_acctbal > 5000 then null else cast(cast(floor(s_acctbal) as bigint) * 12 as string) || ' total' end as `Total năm`, '2023' as `_year` from supplier""",
    "resource_before_odoo": """
        select case when c_mktsegment = 'BUILDING' then '#N/A' when c_mktsegment = 'MACHINERY' then ' ' else ' IS' || cast(c_custkey % 400 as string) || ' ' end as `ISRC`,
               c_name as `Mã bài`, cast(cast(c_acctbal as decimal(18,2)) as string) as `Điểm trung bình`, case when c_acctbal > 0 then '12.5' else 'none' end as `Chi phí đv: $`,
               ' ' || c_mktsegment as `A&R phụ trách`, '' as `Nghệ sỹ` from customer""",
    "sale": f"""
        select case when l_returnflag = 'N' and l_linestatus = 'F' then ' ' else 'Shop ' || l_returnflag end as retailer,
               case when l_linenumber = 7 then '' else 'IS' || cast(l_partkey as string) end as `iSRC`,
               case when l_returnflag = 'A' then ' ' else ' Artist ' || cast(l_suppkey % 10 as string) end as artist,
               substr(cast(l_shipdate as string), 1, 10) as `reportingPeriod`, {_AMOUNT} as earnings from lineitem""",
    "stream_distro": """
        select case when l_linenumber = 6 then ' ' else 'IS' || cast(l_partkey as string) || ' ' end as isrc,
               cast(cast(l_quantity as bigint) as string) || ',' || lpad(cast(l_suppkey as string), 3, '0') as `dailyStream`,
               case when l_returnflag = 'A' then ' ' else substr(cast(l_shipdate as string), 1, 10) end as `reportingDate`,
               case when l_linenumber = 5 then ' ' else 'AR' || cast(l_suppkey % 70 as string) end as `idArtist`, ' Singer ' || cast(l_suppkey as string) as `mainArtist` from lineitem""",
    "usd_rate": "select substr(cast(o_orderdate as string), 1, 10) as record_date, o_totalprice / 10 as exchange_rate from orders "
    "where o_orderpriority = '1-URGENT' and o_totalprice > 250000",
}
