"""Facts and the bridge between videos and edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_end, month_label
from ..functions.safe import safe_divide
from ..functions.text import blank_to_null, digits_number, grouped_number, json_or_text, typed
from ..operators.business import CREDITED, even_share, first_match_links, positional_weights, with_fallback_key, with_rate
from ..operators.dedupe import deduplicate, top_per_group
from ..operators.lists import IdList, lists_to_names
from ..operators.ordered import in_order
from ..operators.reshape import unpivot
from .base import MOMENT, MONEY, NUMBER, RATIO, incremental, keyed, model, reads

# Form of an edit code inside a description, and prefix of stock files.
EDIT_CODE = "(HG[A-Z0-9]{30,34})"
STOCK_PREFIX = "HGFA%"


@model
def bridge_bt_vid(m):
    rows = first_match_links(m.staging("channel_video_info"), "Description", EDIT_CODE, "editing_code")
    fields = {"editing_code": F.col("editing_code"), "video_id": "YoutubeVideoId"}
    return keyed(rows, "bridge_bt_vid_sk", ["YoutubeVideoId", "editing_code"], fields)


@model
def fact_artist_assignment(m):
    artists = m.staging("res_partner").select(F.col("id").alias("_partner"), F.col("name").alias("_artist"))
    rows = m.staging("x_music_plan_detail_price").join(artists, F.col("partner_id") == F.col("_partner"), "left")
    fields = {"production_plan_detail_id": "detail_id", "artist_id": "partner_id", "artist_name": "_artist"}
    return keyed(rows, "fact_artist_assignment_sk", "id", fields)


# Fixed value: receiving company of every distribution.
SHARED_USE = "Dùng chung"


@incremental("fact_distribution_sk", "distribution_date")
def fact_distribution(m):
    """Distributions with the names behind their three id lists."""
    files = m.staging("resource_file_info").select(F.col("Id").alias("_file"), F.col("ResourceFileId").alias("_stock"))
    rows = m.staging("distribution_media_history").join(files, F.col("ResourceFileInfoId") == F.col("_file"), "left")
    lists = [
        IdList("DepartmentData", m.staging("department"), "Id", "Name", "_departments"),
        IdList("GroupData", m.staging("groups"), "Id", "Name", "_teams"),
        IdList("UserData", m.staging("users"), "Id", "DisplayName", "_employees"),
    ]
    rows = lists_to_names(rows, lists)
    return keyed(
        rows,
        "fact_distribution_sk",
        "Id",
        {
            "distribution_id": F.col("Id"),
            "hg_stock_id": F.col("_stock"),
            "distribution_date": F.col("CreatedDate").cast(MOMENT),
            "recipient_company": F.lit(SHARED_USE),
            "department": F.col("_departments"),
            "team": F.col("_teams"),
            "employee": F.col("_employees"),
            "distributed_employee_id": F.col("CreatedByUserId"),
        },
    )


@model
def fact_editing(m):
    """Stock resources used in an edit, numbered by their start in it."""
    edits = m.staging("editings").select(F.col("Id").alias("_edit"), "EditingFileId")
    stock = m.staging("resource").where((F.col("ResourceType") == 0) & F.col("ResourceFileId").like(STOCK_PREFIX))
    stock = stock.select(F.col("Id").alias("_resource"), "ResourceFileId")
    uses = m.staging("resource_editings").select("Id", "EditingId", "ResourcesId", "StartTime", "EndTime")
    rows = uses.join(stock, F.col("ResourcesId") == F.col("_resource")).join(edits, F.col("EditingId") == F.col("_edit"))
    rows = in_order(rows, ["EditingId"], ["StartTime", "Id"], number="position", ties=False)
    return keyed(
        rows,
        "fact_editing_sk",
        "Id",
        {
            "editing_id": F.col("_edit"),
            "editing_code": F.col("EditingFileId"),
            "hg_stock_id": F.col("ResourceFileId"),
            "position": F.col("position"),
            "duration": (F.col("EndTime").cast(NUMBER) - F.col("StartTime").cast(NUMBER)).cast(NUMBER),
        },
    )


@model
def fact_evaluation_assignment(m):
    users = m.staging("review_user").select(F.col("Id").cast("string").alias("_user"), F.col("FullName").alias("_name"))
    rows = m.staging("review").join(users, F.col("CreatedByUserId").cast("string") == F.col("_user"), "left")
    fields = {"reviewer_id": "CreatedByUserId", "score": F.col("Rating").cast(NUMBER), "reviewer_name": "_name"}
    return keyed(rows, "music_evaluation_id", "Id", fields)


@model
def fact_khsx_detail(m):
    return keyed(
        m.staging("x_music_plan_detail"),
        "fact_khsx_detail_sk",
        "id",
        {
            "production_plan_detail_id": "id",
            "production_plan_id": "plan_id",
            "production_manager": "produce_manager",
            "ar_manager": "ar_id",
            "status": "state",
        },
    )


@incremental("fact_label_operation_sk", "release_date")
def fact_label_operation(m):
    """Active songs with a recording code, the lowest id per code, and their certificate."""
    songs = m.staging("x_music_song").where(blank_to_null("isrc").isNotNull() & F.col("active"))
    certificates = m.staging("x_acceptance_cert").select(
        F.col("purchase_order_id").cast("bigint").alias("_order"), "acceptance_link"
    )
    rows = songs.join(certificates, F.col("purchase_order_id").cast("bigint") == F.col("_order"), "left")
    rows = deduplicate(rows, ["isrc"], [F.asc_nulls_last("id"), F.asc_nulls_last("acceptance_link")])
    return keyed(
        rows,
        "fact_label_operation_sk",
        "id",
        {
            "resource_id": "id",
            "release_status": "release_state",
            "release_date": typed("release_date", MOMENT),
            "acceptance_url": "acceptance_link",
            "isrc": "isrc",
            "distributor": "distro",
        },
    )


@incremental("music_evaluation_id", "review_date")
def fact_music_evaluation(m):
    """Reviews with the version of the recording and the mean rating of its listeners."""
    versions = in_order(
        m.staging("recording_sound_version").select("Id", "RecordingSoundId", "CreatedDate"),
        ["RecordingSoundId"],
        ["CreatedDate", "Id"],
        number="_version_no",
        ties=False,
    )
    versions = versions.select(
        F.col("Id").cast("string").alias("_version"), F.col("RecordingSoundId").cast("string").alias("_sound_of"), "_version_no"
    )
    sounds = m.staging("recording_sound").select(F.col("Id").cast("string").alias("_sound"), "SongCode")
    asked = m.staging("version_needs_comment").select(
        F.col("Id").cast("string").alias("_asked"), F.col("RecordingSoundVersionId").cast("string").alias("_rated")
    )
    ratings = m.staging("user_comment_version").select(
        F.col("VersionNeedsCommentId").cast("string").alias("_answer"), F.col("Rating").cast(NUMBER).alias("_rating")
    )
    market = ratings.join(asked, F.col("_answer") == F.col("_asked")).groupBy("_rated")
    market = market.agg(F.avg("_rating").cast(NUMBER).alias("_market"))

    version = F.col("RecordingSoundVersionId").cast("string")
    rows = m.staging("review").join(versions, version == F.col("_version"), "left")
    rows = rows.join(sounds, F.col("_sound_of") == F.col("_sound"), "left").join(market, version == F.col("_rated"), "left")
    internal = F.col("CreatedByUserId").cast("string") == F.lit(m.internal_reviewer).cast("string")
    return keyed(
        rows,
        "music_evaluation_id",
        "Id",
        {
            "resource_id": F.col("SongCode"),
            "version": F.col("_version_no"),
            "internal_score": F.when(internal, F.col("Rating").cast(NUMBER)),
            "marketing_score": F.col("_market"),
            "status": F.col("Concluding"),
            "comment": json_or_text("Comment", "Comment"),
            "review_date": F.col("CreatedDate").cast(MOMENT),
        },
    )


@model
def fact_po_detail(m):
    fields = {"po_detail_id": "id", "po_id": "order_id", "qty_order": "product_qty", "repository": "x_subgenre_id"}
    return keyed(m.staging("purchase_order_line"), "fact_po_detail_sk", "id", fields)


@reads("dim_purchased_resource")
@incremental("cost_id", "incurred_datetime")
def fact_purchase_cost(m):
    """Monthly cost of a partner, spread evenly over the recordings of its repositories."""
    costs = m.staging("purchase_cost")
    wide = costs.select(
        F.trim("Tên đối tác").alias("_partner"),
        F.col("_year"),
        F.col("Total năm").alias("_total"),
        *[F.col(f"CP tháng {n}").alias(str(n)) for n in range(1, 13)],
    )
    long = unpivot(wide, ["_partner", "_year", "_total"], field_name="_month", value_name="_cost")
    # 18 digits of a cost leave a quotient its 12 decimal places.
    long = long.withColumns({"_total": digits_number("_total", "decimal(18,0)"), "_cost": digits_number("_cost", "decimal(18,0)")})
    stores = m.staging("partners").where(blank_to_null("Tên kho trên HG Stock").isNotNull())
    stores = stores.select(F.trim("Tên đối tác").alias("_partner"), F.trim("Tên kho trên HG Stock").alias("repository")).distinct()
    per_store = long.where(F.col("_cost").isNotNull()).join(stores, "_partner")
    members = m.ref("dim_purchased_resource").select("hg_stock_id", "repository")
    rows = even_share(per_store, members, "repository", {"total_cost": "_total", "additional_cost": "_cost"})
    return keyed(
        rows,
        "cost_id",
        ["hg_stock_id", "_year", "_month"],
        {
            "resource_id": F.col("hg_stock_id"),
            "total_cost": F.col("total_cost").cast(RATIO),
            "additional_cost": F.col("additional_cost").cast(RATIO),
            "incurred_datetime": month_end("_year", "_month"),
        },
    )


def member_channels(m, mode: str):
    """Public ids of channels under contract and not suspended.

    ``received`` asks for a start date of the contract, ``not_left`` for no end date.
    """
    dated = {"received": F.col("ReceiveTimeUtc").isNotNull(), "not_left": F.col("OutNetTimeUtc").isNull()}[mode]
    deals = m.staging("channel_deal").where(~F.col("IsOutNet") & ~F.col("IsDeleted") & dated).select("ChannelId")
    own = m.staging("channel_company").where(F.col("Type").isNull()).select("ChannelId")
    open_ = m.staging("channel").where(F.col("SuspendedTimeUtc").isNull()).select("Id", "YoutubeChannelId")
    members = open_.join(deals, F.col("Id") == F.col("ChannelId"), "left_semi")
    return members.join(own, F.col("Id") == F.col("ChannelId"), "left_semi").select("YoutubeChannelId")


def member_metrics(m, mode: str):
    """Daily figures of videos on member channels."""
    videos = m.staging("channel_video_info").select("YoutubeVideoId", "YoutubeChannelId")
    videos = videos.join(member_channels(m, mode), "YoutubeChannelId", "left_semi").select("YoutubeVideoId")
    figures = m.staging("channel_video_metric").where(F.col("YoutubeVideoId").isNotNull() & F.col("Date").isNotNull())
    return figures.join(videos, "YoutubeVideoId")


@reads("bridge_bt_vid", "dim_usd", "fact_editing")
@model
def fact_revenue_by_resources(m):
    """Revenue and views of a video credited to the stock resources of its edit."""
    figures = member_metrics(m, "received").select(
        F.col("YoutubeVideoId").alias("video_id"),
        F.col("Date").cast("date").alias("_day"),
        F.col("EstimatedRevenue").cast(NUMBER).alias("_revenue"),
        F.col("Views").cast(NUMBER).alias("_views"),
    )
    order = [F.asc_nulls_last("position"), F.asc_nulls_last("hg_stock_id")]
    # Only the first five resources of an edit can get credit, so only they meet its videos.
    uses = m.ref("fact_editing").select("editing_code", "hg_stock_id", "position")
    uses = top_per_group(uses, ["editing_code"], order, CREDITED, "_place").drop("_place")
    members = m.ref("bridge_bt_vid").select("video_id", "editing_code").join(uses, "editing_code")
    weighted = positional_weights(members, ["video_id", "editing_code"], order)
    rows = with_rate(weighted.join(figures, "video_id"), F.col("_day"), m.ref("dim_usd"))
    return keyed(
        rows,
        "revenue_id",
        ["video_id", "hg_stock_id", "_day"],
        {
            "video_id": F.col("video_id"),
            "resource_id": F.col("hg_stock_id"),
            "revenue_amount": (F.col("_revenue") * F.col("w") / 10).cast(NUMBER),
            "recorded_date": F.col("_day").cast(MOMENT),
            "view": (F.col("_views") * F.col("w") / 10).cast(NUMBER),
            "exchange_rate": F.col("exchange_rate"),
        },
    )


@reads("dim_usd")
@incremental("fact_revenue_distro_sk", "revenue_month")
def fact_revenue_distro(m):
    """Monthly sales by retailer, recording and artist, with the rate of the first day sold."""
    day = F.col("reportingPeriod").cast("date")
    sales = m.staging("sale").where(blank_to_null("iSRC").isNotNull())
    monthly = sales.groupBy(
        "retailer", F.col("iSRC").alias("isrc"), blank_to_null("artist").alias("artist"), month_label(day).alias("revenue_month")
    ).agg(F.min(day).alias("_first"), F.sum(grouped_number("earnings", NUMBER, strict=True)).cast(NUMBER).alias("revenue_amount"))
    rows = with_rate(monthly, F.col("_first"), m.ref("dim_usd"))
    return keyed(
        rows,
        "fact_revenue_distro_sk",
        ["retailer", "isrc", "revenue_month"],
        {
            "revenue_amount": F.col("revenue_amount"),
            "revenue_month": F.col("revenue_month"),
            "platform": "retailer",
            "isrc": F.col("isrc"),
            "artist": F.col("artist"),
            "exchange_rate": F.col("exchange_rate"),
        },
    )


@reads("dim_usd")
@model
def fact_revenue_yt(m):
    figures = member_metrics(m, "received").where(F.trim("YoutubeVideoId") != "")
    rows = with_rate(figures, F.col("Date").cast("date"), m.ref("dim_usd"))
    return keyed(
        rows,
        "fact_revenue_yt_sk",
        ["YoutubeVideoId", "Date"],
        {
            "video_id": F.col("YoutubeVideoId"),
            "revenue_amount": F.col("EstimatedRevenue").cast(NUMBER),
            "revenue_date": F.col("Date").cast(MOMENT),
            "exchange_rate": F.col("exchange_rate"),
        },
    )


@model
def fact_so_detail(m):
    return keyed(
        m.staging("sale_order_line"),
        "fact_so_detail_sk",
        "id",
        {
            "so_detail_id": "id",
            "so_id": "order_id",
            "repository": "x_subgenre_id",
            "song_qty": typed("product_uom_qty", NUMBER),
            "deadline": "x_deadline",
            "expected_score": typed("x_expected_score", MONEY),
            "production_qty": typed("x_produce_qty", NUMBER),
            "pending_qty": typed("x_qty_in_stock", NUMBER),
        },
    )


@incremental("fact_view_stream_distro_sk", "recorded_date")
def fact_view_stream_distro(m):
    """Daily streams with each retailer that sells the recording."""
    shops = m.staging("sale").where(blank_to_null("iSRC").isNotNull()).select("iSRC", "retailer").distinct()
    shops = shops.select(F.trim("iSRC").alias("_code"), F.col("retailer").alias("_retailer"))
    streams = m.staging("stream_distro").where(blank_to_null("isrc").isNotNull())
    rows = streams.join(shops, F.trim("isrc") == F.col("_code"), "left")
    return keyed(
        rows,
        "fact_view_stream_distro_sk",
        ["isrc", "reportingDate", "idArtist"],
        {
            "stream_count": grouped_number("dailyStream", NUMBER, strict=True),
            "recorded_date": typed("reportingDate", "date"),
            "platform": "_retailer",
            "isrc": "isrc",
            "artist": "idArtist",
        },
    )


@incremental("fact_view_yt_sk", "recorded_date")
def fact_view_yt(m):
    figures = member_metrics(m, "not_left").where(F.trim("YoutubeVideoId") != "")
    views, revenue = F.col("Views").cast(NUMBER), F.col("EstimatedRevenue").cast(NUMBER)
    return keyed(
        figures,
        "fact_view_yt_sk",
        ["YoutubeVideoId", "Date"],
        {
            "video_id": F.col("YoutubeVideoId"),
            "view_count": views,
            "recorded_date": F.col("Date").cast(MOMENT),
            "rpm": safe_divide(revenue.cast("decimal(20,6)"), views.cast("decimal(18,0)")).cast(RATIO),
        },
    )


@incremental("fact_youtube_operation_sk", "submitted_date")
def fact_youtube_operation(m):
    """Songs on the video platform by stock id; a missing id is looked up by recording code."""
    songs = m.staging("x_music_song").select(
        blank_to_null("hg_code").alias("hg_stock_id"),
        blank_to_null("isrc").alias("isrc"),
        blank_to_null("cid_state").alias("cid"),
        blank_to_null("net_cid").alias("net"),
        blank_to_null("hg_link").alias("stock_url"),
        typed("ytb_sent_date", MOMENT).alias("submitted_date"),
    )
    files = m.staging("resource_file_info").select(
        blank_to_null("ISRC").alias("isrc"), blank_to_null("ResourceFileId").alias("found")
    )
    filled = with_fallback_key(songs.where(F.col("isrc").isNotNull()), "hg_stock_id", "isrc", files, "found")
    total = ["isrc", "cid", "net", "stock_url", "submitted_date"]
    rows = deduplicate(filled, ["hg_stock_id"], [F.asc_nulls_last(c) for c in total])
    return keyed(rows, "fact_youtube_operation_sk", "hg_stock_id", {c: F.col(c) for c in ["hg_stock_id", *total]})
