"""Registered queries: one per operator, each over whole given tables, with its SQL twin where one exists.

Wide results are folded to one row per image before they are returned, so that comparing them does
not mean shipping millions of rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake import fixtures as X
from boxlake.functions import geometry as G
from boxlake.functions import losses, paths, text
from boxlake.operators import anchors as N
from boxlake.operators import annotations as A
from boxlake.operators import batching as B
from boxlake.operators import detections as D
from boxlake.operators import history as H
from boxlake.operators import pixels as PX
from boxlake.operators import runs as R
from boxlake.operators import scoring as S
from boxlake.operators import training_loss as TL
from boxlake.plans import evaluate, preprocess, score
from boxlake.session import scratch_dir
from boxlake.sources import files, sinks
from boxlake.streaming import inbox, uploads
from boxlake.streaming import runs as followed
from boxlake.stub_model import make_marked, make_stub

Query = Callable[[SparkSession, str], DataFrame]

ON = ["image_name"]
BOX = ("cx", "cy", "w", "h")
SEED = 7
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- SQL views

VIEWS = {
    "fx_images": X.IMAGES.format(orders="orders"),
    "fx_label_lines": X.LABEL_LINES.format(lineitem="lineitem"),
    "fx_labels": """
select * from (
 select image_name, try_cast(p[1] as float)::double as class_id, try_cast(p[2] as float)::double as cx, try_cast(p[3] as float)::double as cy,
  try_cast(p[4] as float)::double as w, try_cast(p[5] as float)::double as h
 from (select image_name, string_split(value, ' ') as p from fx_label_lines where value <> '') s) t
where class_id is not null and cx is not null and cy is not null and w is not null and h is not null
""",
    "fx_ranked_labels": """
select *, row_number() over (partition by image_name order by class_id, cx, cy, w, h)::int - 1 as pos from fx_labels
""",
    "fx_letterbox": """
select *, cast(floor((256 - new_w) / 2.0) as double) / 256 as pad_x, cast(floor((256 - new_h) / 2.0) as double) / 256 as pad_y from (
 select *, cast(floor(img_width * scale) as int) as new_w, cast(floor(img_height * scale) as int) as new_h from (
  select *, least(256.0::double / img_width, 256.0::double / img_height) as scale from fx_images))
""",
    "fx_moved": """
select i.image_name, i.split_name, i.img_width, i.img_height, i.pad_x, i.pad_y, l.class_id,
 l.cx * (1 - 2 * i.pad_x) + i.pad_x as cx, l.cy * (1 - 2 * i.pad_y) + i.pad_y as cy,
 l.w * (1 - 2 * i.pad_x) as w, l.h * (1 - 2 * i.pad_y) as h
from fx_letterbox i left join fx_labels l using (image_name)
""",
    "fx_anchors": """
select cast(s.first + y.g * s.res + x.g as int) as anchor_id, s.lvl, (x.g + 0.5::double) / s.res as acx,
 (y.g + 0.5::double) / s.res as acy, s.edge as aw, s.edge as ah
from (values (0, 32, 0.1::double, 0), (1, 16, 0.2::double, 1024), (2, 8, 0.4::double, 1280)) s(lvl, res, edge, first)
join range(32) x(g) on x.g < s.res join range(32) y(g) on y.g < s.res
""",
    "fx_pairs": """
select *, inter / greatest((ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter, 1e-6) as iou from (
 select *, greatest(least(ax2, bx2) - greatest(ax1, bx1), 0) * greatest(least(ay2, by2) - greatest(ay1, by1), 0) as inter from (
  select l.image_name, l.cx, l.cy, l.w, l.h, a.anchor_id, a.lvl, a.acx, a.acy, a.aw, a.ah,
   acx - aw / 2 as ax1, acy - ah / 2 as ay1, acx + aw / 2 as ax2, acy + ah / 2 as ay2,
   cx - w / 2 as bx1, cy - h / 2 as by1, cx + w / 2 as bx2, cy + h / 2 as by2
  from fx_labels l cross join fx_anchors a))
""",
    "fx_best": """
select * from (
 select *, row_number() over (partition by image_name, anchor_id order by iou desc, cx, cy, w, h) as place
 from fx_pairs where iou >= 0.3) where place = 1
""",
    "fx_preds": "select concat('img_', cast(c_custkey as string)) as image_name, cast(a as int) as anchor_id, "
    + ", ".join(f"{t.format(k='c_custkey', a='a')} as {n}" for n, t in X.PRED_COLUMNS.items())
    + f" from customer cross join range({N.N_ANCHORS}) r(a)",
    "fx_decoded": """
select image_name, anchor_id, logit0, logit1, score, cx, cy, w, h,
 least(greatest(cx - w / 2, 0), 1) as x1, least(greatest(cy - h / 2, 0), 1) as y1,
 least(greatest(cx + w / 2, 0), 1) as x2, least(greatest(cy + h / 2, 0), 1) as y2 from (
 select p.image_name, p.anchor_id, logit0, logit1, 1 / (1 + exp(logit0 - logit1)) as score,
  least(greatest(dx / 10 * aw + acx, 0), 1) as cx, least(greatest(dy / 10 * ah + acy, 0), 1) as cy,
  least(greatest(exp(least(dw, 4) / 5) * aw, 0.001), 1) as w, least(greatest(exp(least(dh, 4) / 5) * ah, 0.001), 1) as h
 from fx_preds p join fx_anchors a using (anchor_id))
""",
    "fx_focal": """
select image_name, anchor_id, best_iou, gt_cx, gt_cy, gt_w, gt_h, n_gt, kind, weight * (1 - exp(-ce)) * (1 - exp(-ce)) * ce as loss,
 case when kind = 'positive' then
  (select sum(case when abs(d) < 1 then 0.5 * d * d else abs(d) - 0.5 end) from (select unnest([
   dx - 10 * (gt_cx - acx) / aw, dy - 10 * (gt_cy - acy) / ah, dw - 5 * ln(gt_w / aw), dh - 5 * ln(gt_h / ah)]) as d)) end as reg
from (
 select *, case when kind = 'positive' then 0.25 else 0.75 end as weight, greatest(gap, 0) + ln(1 + exp(-abs(gap))) as ce from (
  select p.*, a.acx, a.acy, a.aw, a.ah, b.iou as best_iou, b.cx as gt_cx, b.cy as gt_cy, b.w as gt_w, b.h as gt_h, coalesce(g.n_gt, 0) as n_gt,
   case when b.iou > 0.5 then 'positive' when b.iou is null then 'negative' else 'ignored' end as kind,
   case when b.iou > 0.5 then logit0 - logit1 else logit1 - logit0 end as gap
  from fx_preds p join fx_anchors a using (anchor_id)
  left join fx_best b on b.image_name = p.image_name and b.anchor_id = p.anchor_id
  left join (select image_name, count(*) as n_gt from fx_labels group by 1) g on g.image_name = p.image_name))
""",
    "fx_hard": """
select * from (
 select *, row_number() over (partition by image_name, kind order by floor(loss * 1e12) desc, anchor_id) as place,
  count(*) filter (where kind = 'positive') over (partition by image_name) as n_pos,
  count(*) filter (where kind = 'negative') over (partition by image_name) as n_negative
 from fx_focal)
""",
    "fx_image_loss": """
select image_name, max(n_gt) as n_gt, max(n_pos) as n_pos,
 case when max(n_gt) = 0 then 0 else least(max(n_negative), 3 * greatest(max(n_pos), 1)) end as n_neg,
 case when max(n_gt) = 0 then avg(loss)
  when max(n_pos) > 0 then (coalesce(sum(loss) filter (where kind = 'positive'), 0)
    + coalesce(sum(loss) filter (where kind = 'negative' and place <= 3 * n_pos), 0)) / max(n_pos)
  else coalesce(avg(loss) filter (where kind = 'negative' and place <= 3), 0) end as cls_loss,
 case when max(n_pos) > 0 then sum(reg) / max(n_pos) else 0 end as reg_loss
from fx_hard group by image_name
""",
    "fx_batches": f"""
select *, (row_number() over (partition by split_name order by
 case when split_name = 'train' then (image_no * {B.KEY_FACTOR} + {SEED}) % {B.KEY_BOUND} else image_no end, image_name) - 1) as ordinal
from fx_images
""",
    "fx_batch_loss": """
select split_name, ordinal // 16 as batch_id, count(*) as n_images, avg(cls_loss) as cls_loss, avg(reg_loss) as reg_loss,
 avg(cls_loss) + avg(reg_loss) as loss
from fx_image_loss join fx_batches using (image_name) group by 1, 2
""",
    "fx_history": X.HISTORY.format(events="events"),
    "fx_detections": """
select h.event_id, d.confidence, d.x_min, d.y_min, d.x_max, d.y_max from (
 select event_id, unnest(from_json(replace(detections, '''', '"'),
  '[{"confidence":"DOUBLE","x_min":"INTEGER","y_min":"INTEGER","x_max":"INTEGER","y_max":"INTEGER"}]')) as d from fx_history) h
""",
    "fx_train_log": X.TRAIN_LOG.format(events="events"),
    "fx_epochs": """
select *, val_loss < coalesce(min(val_loss) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding), 'inf'::double) as is_best
from fx_train_log
""",
    "fx_uploads": X.UPLOADS.format(events="events"),
    "fx_legacy": X.LEGACY_HISTORY.format(events="events"),
}


# the same views over the anchor table in place of the grid
VIEWS["fa_anchors"] = "select anchor_id, 0 as lvl, cx as acx, cy as acy, w as aw, h as ah from (" + X.ANCHOR_TABLE.format(part="part") + ")"
VIEWS["fa_preds"] = (
    "select concat('img_', cast(c_custkey as string)) as image_name, a as anchor_id, "
    + ", ".join(f"{t.format(k='c_custkey', a='a')} as {n}" for n, t in X.PRED_COLUMNS.items())
    + " from customer cross join (select anchor_id as a from fa_anchors)"
)
for _name in ("pairs", "best", "focal", "hard", "image_loss"):
    VIEWS[f"fa_{_name}"] = re.sub("fx_(anchors|preds|pairs|best|focal|hard)", r"fa_\1", VIEWS[f"fx_{_name}"])


def _needs(body: str) -> list[str]:
    """Views a text uses, in dependency order."""
    out: list[str] = []
    for name, sql in VIEWS.items():
        if name in body.replace(",", " ").replace(")", " ").replace("(", " ").split():
            for n in [*_needs(sql), name]:
                if n not in out:
                    out.append(n)
    return out


def with_views(body: str, recursive: bool = False) -> str:
    names = _needs(body)
    order = [n for n in VIEWS if n in names]
    heads = ", ".join(f"{n} as ({VIEWS[n]})" for n in order)
    if recursive:
        return f"with recursive {heads}, {body}"
    return f"with {heads} {body}" if heads else body


def query(name: str, sql: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, recursive)
        return fn

    return register


def rounded(frame: DataFrame, digits: int, *names: str) -> DataFrame:
    return frame.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def r(expression: str, digits: int = 6) -> str:
    """`round(x, digits) as x` for a list of names."""
    return ", ".join(f"round({n.strip()}, {digits}) as {n.strip()}" for n in expression.split(","))


# ---------------------------------------------------------------- labels and images


@query("parse_labels", f"select image_name, {r('class_id, cx, cy, w, h')} from fx_labels")
def _(spark, d):
    return rounded(X.labels(spark, d), 6, "class_id", *BOX)


@query("filter_blank", "select image_name, value from fx_label_lines where value <> ''")
def _(spark, d):
    return A.filter_blank(X.label_lines(spark, d))


@query("label_rejects", """
select reason, count(*) as n_lines from (
 select case when trim(value) = '' then 'blank' when len(p) < 5 then 'short'
  when try_cast(p[1] as float) is null or try_cast(p[2] as float) is null or try_cast(p[3] as float) is null
   or try_cast(p[4] as float) is null or try_cast(p[5] as float) is null then 'non_numeric' end as reason
 from (select value, string_split(value, ' ') as p from fx_label_lines)) where reason is not null group by 1""")
def _(spark, d):
    return A.label_rejects(X.label_lines(spark, d))


@query("build_bboxes", f"select image_name, {r('class_id, cx, cy, w, h')}, 1.0::double as pos_mask from fx_labels")
def _(spark, d):
    return rounded(A.build_bboxes(X.labels(spark, d), ON), 6, "class_id", *BOX)


@query("join_images_boxes", f"""
select i.image_name, i.split_name, {r('cx, cy, w, h')}, case when cx is not null then 1.0::double end as pos_mask
from fx_images i left join fx_labels l using (image_name)""")
def _(spark, d):
    joined = A.join_images_boxes(X.images(spark, d), A.build_bboxes(X.labels(spark, d), ON), ON)
    return rounded(joined.select("image_name", "split_name", "pos_mask", *BOX), 6, *BOX)


@query("nulls_to_empty", """
select i.image_name, least(count(l.cx), 20)::int as n_cls, least(count(l.cx), 20)::int as n_mask
from fx_images i left join fx_labels l using (image_name) group by 1""")
def _(spark, d):
    """The first 20 boxes of an image as arrays, the width of a padded example."""
    arrays = B.first_objects(A.build_bboxes(X.labels(spark, d), ON), ON).groupBy(*ON).agg(
        F.collect_list("class_id").alias("cls_targets"), F.collect_list("pos_mask").alias("pos_mask")
    )
    filled = A.nulls_to_empty(X.images(spark, d).join(arrays, ON, "left"), ["cls_targets", "pos_mask"])
    return filled.select("image_name", F.size("cls_targets").alias("n_cls"), F.size("pos_mask").alias("n_mask"))


@query("unlabeled_images", "select image_name, split_name from fx_images where image_name not in (select image_name from fx_labels)")
def _(spark, d):
    return A.unlabeled_images(X.images(spark, d), X.labels(spark, d), ON).select("image_name", "split_name")


@query("orphan_labels", f"""
select concat(image_name, '_lost') as image_name, {r('cx, cy, w, h')} from fx_labels where floor(cx * 1000)::int % 9 = 0""")
def _(spark, d):
    """Labels of every ninth column carry a name that no image has."""
    lost = F.floor(F.col("cx").cast("double") * 1000) % 9 == 0
    names = F.when(lost, F.concat("image_name", F.lit("_lost"))).otherwise(F.col("image_name"))
    labels = X.labels(spark, d).withColumn("image_name", names)
    return rounded(A.orphan_labels(X.images(spark, d), labels, ON).drop("class_id"), 6, *BOX)


@query("num_boxes", "select image_name, count(*) as num_boxes from fx_labels group by 1")
def _(spark, d):
    return A.num_boxes(X.labels(spark, d), ON)


@query("count_images", "select split_name, count(*) as n_images, cast(ceil(count(*) / 16.0) as bigint) as n_batches from fx_images group by 1")
def _(spark, d):
    return A.count_images(X.images(spark, d), 16)


FEATURES = """
 (select i.image_name, i.split_name, l.cx, (l.w * i.img_width) / (l.h * i.img_height) as aspect, l.w * l.h as area
  from fx_images i left join fx_labels l using (image_name))"""


@query("dataset_stats", f"""
select split_name, count(distinct image_name) as total_images, count(cx) as total_boxes, round(avg(aspect), 6) as avg_aspect_ratio,
 round(avg(area), 6) as avg_bbox_area_norm from {FEATURES} group by rollup (split_name)""")
def _(spark, d):
    rows = preprocess.feature_rows(X.images(spark, d), X.label_lines(spark, d), ON)
    return rounded(A.dataset_stats(X.images(spark, d), rows, by_split=True), 6, "avg_aspect_ratio", "avg_bbox_area_norm")


@query("split_filter", "select image_name, img_width, img_height from fx_images where split_id = 1")
def _(spark, d):
    return A.split_filter(X.images(spark, d), 1).drop("image_no")


@query("train_ready", f"select image_name, split_name, {r('cx, cy, w, h', 9)} from fx_moved")
def train_ready(spark, d):
    rows = preprocess.train_ready(X.images(spark, d), X.label_lines(spark, d), ON)
    return rounded(rows.select("image_name", "split_name", *BOX), 9, *BOX)


@query("letterbox_params", "select image_name, round(scale, 9) as scale, new_w, new_h, pad_x, pad_y from fx_letterbox")
def _(spark, d):
    fitted = A.with_letterbox(X.images(spark, d))
    return rounded(fitted.select("image_name", "scale", "new_w", "new_h", "pad_x", "pad_y"), 9, "scale")


@query("transform_boxes", f"select image_name, {r('cx, cy, w, h')} from fx_moved where cx is not null")
def _(spark, d):
    joined = A.join_images_boxes(A.with_letterbox(X.images(spark, d)), A.build_bboxes(X.labels(spark, d), ON), ON)
    one = F.array(F.array(*[F.col(c).cast("double") for c in BOX]))
    moved = G.transform_boxes(one, F.col("scale"), F.col("pad_x"), F.col("pad_y"))
    rows = joined.where(F.col("cx").isNotNull()).select("image_name", F.explode(moved).alias("b"))
    out = rows.select("image_name", *[F.get("b", F.lit(i)).alias(n) for i, n in enumerate(BOX)])
    return rounded(out, 6, *BOX)


def _moved_rows(spark, d) -> DataFrame:
    fitted = A.with_letterbox(X.images(spark, d))
    return A.transform_box_rows(fitted.join(X.labels(spark, d), ON))


def _back_sql(v: str, pad: str, side: str, name: str) -> str:
    return (
        f"cast(trunc(least(greatest((({v}) - {pad}) / greatest(1 - 2 * {pad}, 1e-6), 0), 1) * {side}) as int) as {name}"
    )


@query("inverse_letterbox", f"""
select image_name, {_back_sql('cx - w / 2', 'pad_x', 'img_width', 'x_min')}, {_back_sql('cy - h / 2', 'pad_y', 'img_height', 'y_min')},
 {_back_sql('cx + w / 2', 'pad_x', 'img_width', 'x_max')}, {_back_sql('cy + h / 2', 'pad_y', 'img_height', 'y_max')}
from fx_moved where cx is not null""")
def _(spark, d):
    rows = _moved_rows(spark, d)
    box = G.inverse_letterbox(
        G.cxcywh_to_xyxy(G.Box.of(*BOX)), F.col("pad_x"), F.col("pad_y"), F.col("img_width"), F.col("img_height")
    )
    return rows.select("image_name", *box.named("x_min", "y_min", "x_max", "y_max"))


def _label_boxes(spark, d) -> DataFrame:
    return X.labels(spark, d).select("image_name", *[F.col(c).cast("double").alias(c) for c in BOX])


@query("cxcywh_to_xyxy", """
select image_name, round(cx - w / 2, 6) as x1, round(cy - h / 2, 6) as y1, round(cx + w / 2, 6) as x2, round(cy + h / 2, 6) as y2 from fx_labels""")
def _(spark, d):
    box = G.cxcywh_to_xyxy(G.Box.of(*BOX))
    return rounded(_label_boxes(spark, d).select("image_name", *box.named(*D.CORNERS)), 6, *D.CORNERS)


@query("xyxy_to_cxcywh", """
select image_name, round((cx - w / 2 + (cx + w / 2)) / 2, 6) as cx, round((cy - h / 2 + (cy + h / 2)) / 2, 6) as cy,
 round(cx + w / 2 - (cx - w / 2), 6) as w, round(cy + h / 2 - (cy - h / 2), 6) as h from fx_labels""")
def _(spark, d):
    corners = _label_boxes(spark, d).select("image_name", *G.cxcywh_to_xyxy(G.Box.of(*BOX)).named(*D.CORNERS))
    return rounded(corners.select("image_name", *G.xyxy_to_cxcywh(G.Box.of(*D.CORNERS)).named(*BOX)), 6, *BOX)


@query("box_iou", """
select image_name, round(inter / greatest(a + b - inter, 1e-6), 6) as iou from (
 select m.image_name, l.w * l.h as a, m.w * m.h as b,
  greatest(least(l.cx + l.w / 2, m.cx + m.w / 2) - greatest(l.cx - l.w / 2, m.cx - m.w / 2), 0)
  * greatest(least(l.cy + l.h / 2, m.cy + m.h / 2) - greatest(l.cy - l.h / 2, m.cy - m.h / 2), 0) as inter
 from (select i.image_name, l.cx as lx, l.cy as ly, l.w as lw, l.h as lh, i.pad_x, i.pad_y from fx_letterbox i join fx_labels l using (image_name)) s,
  lateral (select lx as cx, ly as cy, lw as w, lh as h) l,
  lateral (select s.image_name, lx * (1 - 2 * pad_x) + pad_x as cx, ly * (1 - 2 * pad_y) + pad_y as cy, lw * (1 - 2 * pad_x) as w, lh * (1 - 2 * pad_y) as h) m)""")
def _(spark, d):
    """Overlap of each box with its letterboxed self."""
    fitted = A.with_letterbox(X.images(spark, d))
    rows = fitted.join(X.labels(spark, d), ON)
    box = G.Box(*[F.col(c).cast("double") for c in BOX])
    moved = G.transform_box(box, F.col("pad_x"), F.col("pad_y"))
    iou = G.box_iou(G.cxcywh_to_xyxy(box), G.cxcywh_to_xyxy(moved))
    return rounded(rows.select("image_name", iou.alias("iou")), 6, "iou")


@query("box_features", """
select image_name, num_boxes, round((cx - w / 2) * img_width, 4) as x_min, round((cy - h / 2) * img_height, 4) as y_min,
 round((cx + w / 2) * img_width, 4) as x_max, round((cy + h / 2) * img_height, 4) as y_max,
 round(w * img_width * (h * img_height), 4) as bbox_area, round(w * h, 6) as bbox_area_norm,
 round(w * img_width / (h * img_height), 6) as aspect_ratio,
 case when w * h < 0.01 then 'small' when w * h < 0.05 then 'medium' else 'large' end as bbox_size_category,
 case when cx < 0.5 then 'left' else 'right' end as center_x_quadrant, case when cy < 0.5 then 'top' else 'bottom' end as center_y_quadrant
from (select *, count(*) over (partition by image_name) as num_boxes from fx_images join fx_labels using (image_name))""")
def _(spark, d):
    rows = preprocess.feature_rows(X.images(spark, d), X.label_lines(spark, d), ON)
    out = rows.select(
        "image_name", "num_boxes", "x_min", "y_min", "x_max", "y_max", "bbox_area", "bbox_area_norm", "aspect_ratio",
        "bbox_size_category", "center_x_quadrant", "center_y_quadrant",
    )
    return rounded(rounded(out, 4, "x_min", "y_min", "x_max", "y_max", "bbox_area"), 6, "bbox_area_norm", "aspect_ratio")


@query("pad_targets", """
select i.image_name, s.slot::int as slot, round(coalesce(l.class_id, 0)::double, 6) as cls, round(coalesce(l.cx, 0), 6) as cx, round(coalesce(l.cy, 0), 6) as cy,
 round(coalesce(l.w, 0), 6) as w, round(coalesce(l.h, 0), 6) as h, case when l.cx is null then 0.0::double else 1.0::double end as mask
from fx_images i cross join range(20) s(slot) left join fx_ranked_labels l on l.image_name = i.image_name and l.pos = s.slot""")
def _(spark, d):
    padded = B.pad_targets(X.images(spark, d), X.labels(spark, d), ON)
    rows = padded.select("image_name", F.posexplode_outer(F.arrays_zip("cls", "reg", "mask")).alias("slot", "e"))
    out = rows.select(
        "image_name", "slot", F.col("e.cls").alias("cls"),
        *[F.get("e.reg", F.lit(i)).alias(n) for i, n in enumerate(BOX)], F.col("e.mask").alias("mask"),
    )
    return rounded(out, 6, "cls", *BOX)


@query("num_pos", """
select i.image_name, greatest(least(count(l.cx), 20), 1)::double as num_pos
from fx_images i left join fx_labels l using (image_name) group by 1""")
def _(spark, d):
    padded = B.pad_targets(X.images(spark, d), X.labels(spark, d), ON)
    return padded.select("image_name", B.num_pos(F.col("mask")).alias("num_pos"))


def _key():
    return B.shuffle_key(F.col("image_no"), SEED)


@query("make_batches", "select image_name, split_name, ordinal, ordinal // 16 as batch_id from fx_batches")
def _(spark, d):
    return B.make_batches(X.images(spark, d), _key(), F.col("image_no")).select("image_name", "split_name", "ordinal", "batch_id")


@query("image_at", f"""
select ordinal, image_name from (
 select image_name, row_number() over (order by (image_no * {B.KEY_FACTOR} + {SEED}) % {B.KEY_BOUND}, image_name) - 1 as ordinal from fx_images)
where ordinal = 500""")
def _(spark, d):
    out = scratch_dir(spark, "ordered")
    B.store_ordered(X.images(spark, d), out, _key())
    return B.image_at(spark, out, 500)


@query("sample_images", f"""
select image_name, split_name from fx_images order by (image_no * {B.KEY_FACTOR} + {SEED}) % {B.KEY_BOUND}, image_name limit 24""")
def _(spark, d):
    return B.sample_images(X.images(spark, d), _key()).select("image_name", "split_name")


@query("repartition_batch", "select split_name, count(*) as n, sum(image_no)::bigint as checksum from fx_images group by 1")
def _(spark, d):
    spread = B.repartition_batch(X.images(spark, d))
    return spread.groupBy("split_name").agg(F.count(F.lit(1)).alias("n"), F.sum("image_no").alias("checksum"))


# ---------------------------------------------------------------- paths, trees and tables

PATH_SQL = "concat('/data/test/', split_name, '/images/', replace(image_name, '_', ' +'), '.jpg')"


def _paths(spark, d) -> DataFrame:
    """Image paths below a folder that is itself called like a split, with blanks and plus signs."""
    return X.images(spark, d).select("image_no", F.expr(PATH_SQL).alias("path"))


@query("split_from_path", "select image_no, split_name, split_id from fx_images")
def _(spark, d):
    split = paths.split_from_path(F.col("path"))
    return _paths(spark, d).select("image_no", split.alias("split_name"), paths.split_id(split).alias("split_id"))


@query("name_from_path", "select image_no, replace(image_name, '_', ' +') as image_name, '' as not_text from fx_images")
def _(spark, d):
    return _paths(spark, d).select(
        "image_no", paths.name_from_path(F.col("path"), "jpg").alias("image_name"),
        paths.name_from_path(F.col("path"), "txt").alias("not_text"),
    )


@query("name_in_memory_batch", "select image_no, concat('img_', cast(image_no as string), '.jpg') as filename from fx_images")
def _(spark, d):
    return S.name_in_memory_batch(X.images(spark, d).select("image_no"), "image_no")


def _label_tree(spark, d) -> str:
    """The label lines as a tree of text files, one folder per split."""
    root = scratch_dir(spark, "labels")
    lines = X.label_lines(spark, d).join(X.images(spark, d).select("image_name", "split_name"), "image_name")
    for split in ("train", "valid", "test"):
        lines.where(F.col("split_name") == split).select("value").write.text(f"{root}/{split}/labels")
    return root


@query("scan_label_lines", """
select split_name, split_id, value, count(*) as n_lines from fx_label_lines join fx_images using (image_name) group by 1, 2, 3""")
def _(spark, d):
    lines = files.scan_label_lines(spark, _label_tree(spark, d))
    return lines.groupBy("split_name", "split_id", "value").agg(F.count(F.lit(1)).alias("n_lines"))


@query("scan_inbox", "select sum(length(value) + 1)::bigint as n_bytes from fx_label_lines where value is not null")
def _(spark, d):
    root = scratch_dir(spark, "inbox")
    X.label_lines(spark, d).select("value").write.text(root)
    return files.scan_inbox(spark, root).agg(F.sum(F.length("image_bytes")).alias("n_bytes"))


@query("export_splits", "select split_name, count(*) as n_rows, count(distinct image_name) as n_images, round(sum(cx), 4) as sum_cx from fx_moved group by 1")
def _(spark, d):
    out = scratch_dir(spark, "export")
    rows = preprocess.train_ready(X.images(spark, d), X.label_lines(spark, d), ON)
    sinks.export_splits(rows.select("image_name", "split_name", "split_id", *BOX), out)
    back = files.read_training_table(spark, out)
    agg = back.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("image_name").alias("n_images"), F.sum("cx").alias("sum_cx")
    )
    return rounded(agg, 4, "sum_cx")


@query("read_training_table", f"select image_name, split_name, {r('cx, cy, w, h', 9)} from fx_moved")
def _(spark, d):
    out = scratch_dir(spark, "training")
    rows = preprocess.train_ready(X.images(spark, d), X.label_lines(spark, d), ON)
    sinks.export_splits(rows.select("image_name", "split_name", "split_id", *BOX), out)
    return rounded(files.read_training_table(spark, out).select("image_name", "split_name", *BOX), 9, *BOX)


# ---------------------------------------------------------------- anchors


@query("match_anchors", """
select image_name, anchor_id, count(*) as n_pairs, round(sum(iou), 6) as sum_iou, round(max(iou), 9) as max_iou
from fx_pairs where iou >= 0.3 group by 1, 2""")
def _(spark, d):
    pairs = N.match_anchors(X.labels(spark, d))
    agg = pairs.groupBy("image_name", "anchor_id").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("iou").alias("sum_iou"), F.max("iou").alias("max_iou")
    )
    return rounded(rounded(agg, 6, "sum_iou"), 9, "max_iou")


def _best(spark, d) -> DataFrame:
    return N.best_gt(N.match_anchors(X.labels(spark, d)))


@query("best_gt", "select image_name, anchor_id, round(iou, 9) as best_iou from fx_best")
def _(spark, d):
    return rounded(_best(spark, d).select("image_name", "anchor_id", "best_iou"), 9, "best_iou")


@query("gather_best_gt", f"select image_name, anchor_id, {r('cx, cy, w, h')} from fx_best")
def _(spark, d):
    return rounded(_best(spark, d).drop("best_iou"), 6, *BOX)


@query("anchor_assignment", f"""
select i.image_name, count(*) filter (where b.iou > 0.5) as positive, count(*) filter (where b.iou <= 0.5) as ignored,
 {N.N_ANCHORS} - count(b.iou) as negative from fx_images i left join fx_best b using (image_name) group by 1""")
def _(spark, d):
    return N.anchor_assignment(X.images(spark, d), X.labels(spark, d))


@query("anchor_coverage", """
select case when area < 0.01 then 'small' when area < 0.05 then 'medium' else 'large' end as size_class,
 case when max_iou > 0.5 then lvl else -1 end as lvl, count(*) as n_boxes from (
 select no, max(w * h) as area, max(iou) as max_iou, arg_max(lvl, iou) as lvl from (
  select no, w, h, lvl, inter / greatest(aw * ah + w * h - inter, 1e-6) as iou from (
   select l.*, a.lvl, a.aw, a.ah, greatest(least(acx + aw / 2, cx + w / 2) - greatest(acx - aw / 2, cx - w / 2), 0)
     * greatest(least(acy + ah / 2, cy + h / 2) - greatest(acy - ah / 2, cy - h / 2), 0) as inter
   from (select *, row_number() over () as no from fx_labels) l cross join fx_anchors a)) group by no) group by 1, 2""")
def _(spark, d):
    return N.anchor_coverage(X.labels(spark, d))


@query("match_anchor_table", """
select image_name, anchor_id, count(*) as n_pairs, round(sum(iou), 6) as sum_iou, round(max(iou), 9) as max_iou
from fa_pairs where iou >= 0.3 group by 1, 2""")
def _(spark, d):
    pairs = N.match_anchor_table(X.labels(spark, d), X.anchor_table(spark, d))
    agg = pairs.groupBy("image_name", "anchor_id").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("iou").alias("sum_iou"), F.max("iou").alias("max_iou")
    )
    return rounded(rounded(agg, 6, "sum_iou"), 9, "max_iou")


@query("best_gt_of_table", f"select image_name, anchor_id, round(iou, 9) as best_iou, {r('cx, cy, w, h')} from fa_best")
def _(spark, d):
    best = N.best_gt(N.match_anchor_table(X.labels(spark, d), X.anchor_table(spark, d)))
    return rounded(rounded(best, 6, *BOX), 9, "best_iou")


@query("encode_boxes", """
select image_name, anchor_id, round(10 * (cx - acx) / aw, 6) as dx, round(10 * (cy - acy) / ah, 6) as dy,
 round(5 * ln(w / aw), 6) as dw, round(5 * ln(h / ah), 6) as dh from fx_best where iou > 0.5""")
def _(spark, d):
    best = _best(spark, d).where(F.col("best_iou") > F.lit(N.POSITIVE_IOU))
    deltas = G.encode_boxes(G.Box.of(*BOX), N.anchor_box(F.col("anchor_id")))
    return rounded(best.select("image_name", "anchor_id", *deltas.named("dx", "dy", "dw", "dh")), 6, "dx", "dy", "dw", "dh")


# ---------------------------------------------------------------- detections


def _fold(rows: DataFrame, digits: int, *names: str) -> DataFrame:
    """Count, sum, extremes and two sums weighted by anchor of columns per image; exchanged values change the weighted sums."""
    def weighted(power: int):
        return lambda n: F.sum(F.col(n).cast("double") * (F.col("anchor_id") * F.lit(37) % F.lit(101) + 1) ** power)

    kinds = {"sum": F.sum, "min": F.min, "max": F.max, "by_anchor": weighted(1), "by_square": weighted(2)}
    out = rows.groupBy("image_name").agg(
        F.count(F.lit(1)).alias("n"), *[f(n).alias(f"{k}_{n}") for n in names for k, f in kinds.items()],
    )
    return rounded(out, digits, *[f"{k}_{n}" for n in names for k in kinds])


def _fold_sql(source: str, digits: int, *names: str) -> str:
    cells = ", ".join(
        f"round({k}({n}::double), {digits}) as {k}_{n}" for n in names for k in ("sum", "min", "max")
    ) + "".join(
        f", round(sum({n}::double * power(anchor_id * 37 % 101 + 1, {power})), {digits}) as {k}_{n}"
        for n in names for power, k in ((1, "by_anchor"), (2, "by_square"))
    )
    return f"select image_name, count(*) as n, {cells} from {source} group by image_name"


@query("join_preds_anchors", _fold_sql("(select * from fx_preds join fx_anchors using (anchor_id))", 4, "acx", "acy", "aw", "lvl", "dx"))
def _(spark, d):
    return _fold(D.join_preds_anchors(X.predictions(spark, d), N.make_anchors(spark)), 4, "acx", "acy", "aw", "lvl", "dx")


@query("softmax_score", _fold_sql("fx_decoded", 6, "score"))
def _(spark, d):
    preds = X.predictions(spark, d)
    return _fold(preds.select("image_name", "anchor_id", G.softmax_score(F.col("logit0"), F.col("logit1")).alias("score")), 6, "score")


@query("decode_boxes", _fold_sql("fx_decoded", 6, "cx", "cy", "w", "h"))
def _(spark, d):
    box = G.decode_boxes(G.Box.of("dx", "dy", "dw", "dh"), N.anchor_box(F.col("anchor_id")))
    return _fold(X.predictions(spark, d).select("image_name", "anchor_id", *box.named(*BOX)), 6, *BOX)


@query("clip_boxes", _fold_sql("fx_decoded", 6, "x1", "y1", "x2", "y2"))
def _(spark, d):
    box = G.decode_boxes(G.Box.of("dx", "dy", "dw", "dh"), N.anchor_box(F.col("anchor_id")))
    corners = G.clip_boxes(G.cxcywh_to_xyxy(box))
    return _fold(X.predictions(spark, d).select("image_name", "anchor_id", *corners.named(*D.CORNERS)), 6, *D.CORNERS)


@query("score_filter", _fold_sql("(select * from fx_decoded where score > 0.5)", 6, "score", "x1", "y2"))
def _(spark, d):
    return _fold(D.candidates(X.predictions(spark, d), 0.5), 6, "score", "x1", "y2")


@query("explode_predictions", _fold_sql("fx_preds", 4, "logit0", "logit1", "dx", "dh"))
def _(spark, d):
    return _fold(D.explode_predictions(X.predictions_wide(spark, d)), 4, "logit0", "logit1", "dx", "dh")


NMS_SQL = """
fx_cand as materialized (
 select *, row_number() over (partition by image_name order by score desc, anchor_id) as rn from fx_decoded where score > {threshold}),
fx_step(image_name, rn, kept) using key (image_name) as (
 select image_name, rn, [{{'a': anchor_id, 's': score, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] from fx_cand where rn = 1
 union
 select c.image_name, c.rn, case when len(s.kept) >= {limit} or len(list_filter(s.kept, lambda e:
   greatest(least(e.x2, c.x2) - greatest(e.x1, c.x1), 0) * greatest(least(e.y2, c.y2) - greatest(e.y1, c.y1), 0)
   > 0.4 * greatest((e.x2 - e.x1) * (e.y2 - e.y1) + (c.x2 - c.x1) * (c.y2 - c.y1)
    - greatest(least(e.x2, c.x2) - greatest(e.x1, c.x1), 0) * greatest(least(e.y2, c.y2) - greatest(e.y1, c.y1), 0), 1e-6))) > 0
  then s.kept else list_append(s.kept, {{'a': c.anchor_id, 's': c.score, 'x1': c.x1, 'y1': c.y1, 'x2': c.x2, 'y2': c.y2}}) end
 from fx_step s join fx_cand c on c.image_name = s.image_name and c.rn = s.rn + 1 where len(s.kept) < {limit})
select image_name, generate_subscripts(kept, 1)::int - 1 as det_rank, unnest(kept).a as anchor_id, round(unnest(kept).s, 6) as score,
 round(unnest(kept).x1, 6) as x1, round(unnest(kept).y1, 6) as y1, round(unnest(kept).x2, 6) as x2, round(unnest(kept).y2, 6) as y2
from fx_step
"""


@query("nms", NMS_SQL.format(threshold=0.5, limit=100), recursive=True)
def _(spark, d):
    kept = D.nms(D.candidates(X.predictions(spark, d), 0.5))
    return rounded(kept, 6, "score", *D.CORNERS)


# three images that hold all label boxes, drawn together around the corners of a 40 x 40 grid
CROWDED = """
select concat('scene_', cast(row_no % 3 as string)) as image_name, row_no as anchor_id, cast((row_no * 7919) % 1009 as double) / 1009 as score,
 px - sx as x1, py - sy as y1, px + sx as x2, py + sy as y2 from (
 select row_no, floor(cx * 40) / 40 + (cx * 40 - floor(cx * 40)) * 0.006 as px, floor(cy * 40) / 40 + (cy * 40 - floor(cy * 40)) * 0.006 as py,
  0.006 + w / 80 as sx, 0.006 + h / 80 as sy from (
  select *, cast(row_number() over (order by image_name, class_id, cx, cy, w, h) as int) as row_no from {labels}))
"""
VIEWS["fx_crowd"] = CROWDED.format(labels="fx_labels")


@query("nms_any", NMS_SQL.format(threshold=-1, limit=400).replace("fx_decoded", "fx_crowd"), recursive=True)
def _(spark, d):
    kept = D.nms_any(X.crowd(spark, d), 0.4, 400)
    return rounded(kept, 6, "score", *D.CORNERS)


@query("predict", NMS_SQL.format(threshold=0.9, limit=100), recursive=True)
def _(spark, d):
    found = D.predict(X.predictions_wide(spark, d), 0.9)
    rows = found.select("image_name", F.posexplode("boxes").alias("det_rank", "b")).select("image_name", "det_rank", "b.*")
    return rounded(rows, 6, "score", *D.CORNERS)


@query("max_detections", NMS_SQL.format(threshold=0.9, limit=10), recursive=True)
def _(spark, d):
    kept = D.max_detections(D.nms(D.candidates(X.predictions(spark, d), 0.9)), 10)
    return rounded(kept, 6, "score", *D.CORNERS)


# ---------------------------------------------------------------- losses


@query("focal_loss", """
select image_name, count(*) as n, round(sum(0.75 * (1 - exp(-c0)) * (1 - exp(-c0)) * c0), 5) as sum_background,
 round(sum(0.25 * (1 - exp(-c1)) * (1 - exp(-c1)) * c1), 5) as sum_object from (
 select image_name, greatest(logit1 - logit0, 0) + ln(1 + exp(-abs(logit1 - logit0))) as c0,
  greatest(logit0 - logit1, 0) + ln(1 + exp(-abs(logit1 - logit0))) as c1 from fx_preds) group by 1""")
def _(spark, d):
    l0, l1 = F.col("logit0"), F.col("logit1")
    out = X.predictions(spark, d).groupBy("image_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(losses.focal_loss(l0, l1, F.lit(0))).alias("sum_background"),
        F.sum(losses.focal_loss(l0, l1, F.lit(1))).alias("sum_object"),
    )
    return rounded(out, 5, "sum_background", "sum_object")


@query("smooth_l1", """
select image_name, round(sum(case when abs(dx - dw) < 1 then 0.5 * (dx - dw) * (dx - dw) else abs(dx - dw) - 0.5 end), 5) as loss
from fx_preds group by 1""")
def _(spark, d):
    out = X.predictions(spark, d).groupBy("image_name").agg(F.sum(losses.smooth_l1(F.col("dx"), F.col("dw"))).alias("loss"))
    return rounded(out, 5, "loss")


@query("hard_negatives", """
select image_name, place::int - 1 as neg_rank, anchor_id, round(loss, 6) as loss from fx_hard
where n_gt > 0 and kind = 'negative' and place <= 3 * greatest(n_pos, 1)""")
def _(spark, d):
    logits = partial(X.fill_predictions, lists=["logits"])
    return rounded(TL.hard_negatives(X.prediction_images(spark, d), X.labels(spark, d), predict=logits), 6, "loss")


@query("image_loss", "select image_name, n_gt, n_pos::int as n_pos, n_neg::int as n_neg, round(cls_loss, 6) as cls_loss, round(reg_loss, 6) as reg_loss from fx_image_loss")
def _(spark, d):
    losses = TL.image_loss(X.prediction_images(spark, d), X.labels(spark, d), predict=X.fill_predictions)
    return rounded(losses, 6, "cls_loss", "reg_loss")


@query("image_loss_of_table", "select image_name, n_gt, n_pos::int as n_pos, n_neg::int as n_neg, round(cls_loss, 6) as cls_loss, round(reg_loss, 6) as reg_loss from fa_image_loss")
def _(spark, d):
    anchors = X.anchor_table(spark, d)
    predict = partial(X.fill_predictions, n_anchors=anchors.count())
    losses = TL.image_loss(X.prediction_images(spark, d), X.labels(spark, d), anchors=anchors, predict=predict)
    return rounded(losses, 6, "cls_loss", "reg_loss")


def _batch_losses(spark, d) -> DataFrame:
    return evaluate.batch_losses(
        X.images(spark, d), X.prediction_images(spark, d), X.labels(spark, d), _key(), F.col("image_no"), predict=X.fill_predictions
    )


@query("batch_loss", f"select split_name, batch_id, n_images, {r('cls_loss, reg_loss, loss')} from fx_batch_loss")
def _(spark, d):
    return rounded(_batch_losses(spark, d), 6, "cls_loss", "reg_loss", "loss")


@query("epoch_metrics", """
select split_name, count(*) as n_batches, round(avg(loss), 6) as loss, round(avg(cls_loss), 6) as cls_loss, round(avg(reg_loss), 6) as reg_loss
from fx_batch_loss group by 1""")
def _(spark, d):
    return rounded(evaluate.epoch_losses(_batch_losses(spark, d)), 6, "cls_loss", "reg_loss", "loss")


# ---------------------------------------------------------------- history

HISTORY_SCHEMA = (
    "timestamp timestamp_ntz, image_name string, nb_plates int, detections string, status string, "
    "original_image_path string, annotated_image_path string"
)


def _history_table(spark, d) -> DataFrame:
    return X.history(spark, d).withColumn("annotated_image_path", F.lit(None).cast("string")).select(
        *[c.split()[0] for c in HISTORY_SCHEMA.split(", ")]
    )


@query("scan_history", "select timestamp, image_name, nb_plates, detections, status, original_image_path from fx_history")
def _(spark, d):
    out = scratch_dir(spark, "history-csv")
    sinks.append_history_csv(_history_table(spark, d), out)
    return files.scan_history(spark, out).drop("annotated_image_path")


@query("parse_detections", """
select h.event_id, h.nb_plates, count(x.event_id)::int as n_parsed, round(coalesce(sum(x.confidence), 0), 6) as sum_confidence
from fx_history h left join fx_detections x using (event_id) group by 1, 2""")
def _(spark, d):
    parsed = H.parsed_history(X.history(spark, d))
    total = F.aggregate("detections", F.lit(0.0), lambda t, x: t + x["confidence"])
    out = parsed.select("event_id", "nb_plates", F.size("detections").alias("n_parsed"), total.alias("sum_confidence"))
    return rounded(out, 6, "sum_confidence")


@query("explode_detections", """
select h.event_id, h.status, coalesce(x.confidence, -1) as confidence, coalesce(x.x_min, -1) as x_min, coalesce(x.y_min, -1) as y_min,
 coalesce(x.x_max, -1) as x_max, coalesce(x.y_max, -1) as y_max from fx_history h left join fx_detections x using (event_id)""")
def _(spark, d):
    rows = H.parsed_history(X.history(spark, d)).select("event_id", "status", "detections")
    return H.explode_detections(rows).fillna(-1)


@query("detections_json", "select event_id, confidence, x_min, y_min, x_max, y_max from fx_detections")
def _(spark, d):
    wire = H.parsed_history(X.history(spark, d)).select("event_id", text.detections_json(F.col("detections")).alias("wire"))
    back = wire.select("event_id", text.from_detections_json(F.col("wire")).alias("detections"))
    return H.explode_detections(back, keep_empty=False)


@query("latest_history", "select event_id, timestamp, image_name, nb_plates, status from fx_history order by timestamp desc, event_id desc limit 30")
def _(spark, d):
    return H.latest_history(X.history(spark, d)).select("event_id", "timestamp", "image_name", "nb_plates", "status")


def _stored_in_batches(spark, d) -> str:
    """The history as six batches of equal lengths of time, by two writers."""
    out = scratch_dir(spark, "history-batches")
    rows = X.history(spark, d).select("event_id", "timestamp", "image_name", "nb_plates", "status")
    span = rows.agg(F.unix_seconds(F.min("timestamp").cast("timestamp")).alias("a"), F.unix_seconds(F.max("timestamp").cast("timestamp")).alias("z")).first()
    if span.a is None:
        sinks.append_history(rows, out, "a", 0)
        return out
    part = F.floor((F.unix_seconds(F.col("timestamp").cast("timestamp")) - span.a) * 6 / (span.z - span.a + 1))
    for n in range(6):
        sinks.append_history(rows.where(part == n), out, "ab"[n % 2], n)
    return out


NEWEST_SCHEMA = "event_id long, timestamp timestamp_ntz, image_name string, nb_plates int, status string"


@query("latest_history_of_batches", "select event_id, timestamp, image_name, nb_plates, status from fx_history order by timestamp desc, event_id desc limit 30")
def _(spark, d):
    near = sinks.read_newest_history(spark, _stored_in_batches(spark, d), NEWEST_SCHEMA, H.SERVICE_LIMIT)
    return H.latest_history(near).drop("writer", "batch_id")


@query("history_stats_of_batches", """
select count(*) as total_predictions, sum(nb_plates)::bigint as total_plates
from (select nb_plates from fx_history order by timestamp desc, event_id desc limit 1000)""")
def _(spark, d):
    near = sinks.read_newest_history(spark, _stored_in_batches(spark, d), NEWEST_SCHEMA, H.STATS_ROWS)
    return H.history_stats(near, newest=H.STATS_ROWS)


@query("history_view", """
select event_id, date_trunc('second', timestamp)::timestamp as datetime, image_name as filename, nb_plates, status, detections from fx_history""")
def _(spark, d):
    return H.history_view(X.history(spark, d)).drop("original_image_path")


@query("history_stats", """
select count(*) as total_predictions, sum(nb_plates)::bigint as total_plates
from (select nb_plates from fx_history order by timestamp desc, event_id desc limit 1000)""")
def _(spark, d):
    return H.history_stats(X.history(spark, d), newest=H.STATS_ROWS)


@query("history_totals", "select count(*) as total_predictions, sum(nb_plates)::bigint as total_plates from fx_history")
def _(spark, d):
    return H.history_stats(X.history(spark, d))


@query("history_by_run", """
select regexp_extract(original_image_path, 'runs/([^/]+)/', 1) as run_id, count(*) as total_images, sum(nb_plates)::bigint as total_plates
from fx_history group by 1""")
def _(spark, d):
    return H.history_by_run(X.history(spark, d))


@query("batch_totals", """
select regexp_extract(original_image_path, 'runs/([^/]+)/', 1) as run_id, count(*) as total_images, sum(nb_plates)::bigint as total_plates,
 count(*) filter (where status = 'success') as n_success, count(*) filter (where status <> 'success') as n_error from fx_history group by 1""")
def _(spark, d):
    runs = X.history(spark, d).withColumn("run_id", paths.run_from_path(F.col("original_image_path")))
    return H.batch_totals(runs)


HOURLY_SQL = """
select date_trunc('hour', timestamp)::timestamp as hour, count(*) as n_predictions, sum(nb_plates)::bigint as n_plates,
 count(*) filter (where status <> 'success') as n_error from fx_history group by 1"""


@query("hourly_predictions", HOURLY_SQL)
def _(spark, d):
    return H.hourly_predictions(X.history(spark, d)).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("stream_hourly_counts", HOURLY_SQL)
def _(spark, d):
    """The same counts from a stream over the stored history."""
    root = scratch_dir(spark, "hourly")
    X.history(spark, d).select("timestamp", "nb_plates", "status").write.parquet(f"{root}/history")
    stored = spark.readStream.schema("timestamp timestamp_ntz, nb_plates int, status string").parquet(f"{root}/history")
    inbox.drain_to_table(inbox.hourly_counts(stored, "1 hour"), f"{root}/counts", f"{root}/state")
    counts = inbox.latest_counts(spark, f"{root}/counts")
    return counts.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("upload_filter", """
select filename, seq, round(value, 6) as value from (
 select *, row_number() over (partition by filename order by seq desc) as rn from (
  select seq, value, case when filename = '' then concat('img_', cast(seq as string), '.jpg') else regexp_extract(filename, '([^/]*)$', 1) end as filename
  from fx_uploads where content_type like 'image/%')) where rn = 1""")
def _(spark, d):
    return rounded(H.upload_filter(X.uploads(spark, d)).drop("content_type"), 6, "value")


# uploads of a name within a day of each other are one session; two rows of a later year close them all and stay open themselves
@query("stream_uploads", """
select filename, seq, round(value, 6) as value from (
 select *, row_number() over (partition by filename, session order by seq desc) as rn from (
  select *, sum(case when arrived < before + interval 1 day then 0 else 1 end) over (partition by filename order by arrived rows unbounded preceding) as session from (
   select *, lag(arrived) over (partition by filename order by arrived) as before from (
    select u.seq, u.value, e.ts as arrived, case when filename = '' then concat('img_', cast(seq as string), '.jpg') else regexp_extract(filename, '([^/]*)$', 1) end as filename
    from fx_uploads u join events e on e.event_id = u.seq where content_type like 'image/%')))) where rn = 1""")
def _(spark, d):
    """The uploads as files of a stream in three parts by time, each read by a query that goes on from the checkpoint."""
    root = scratch_dir(spark, "uploads")
    events = X.table(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("arrived"))
    arrivals = X.uploads(spark, d).join(events, "seq")
    day = F.dayofmonth("arrived")
    closing = arrivals.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("seq"), F.lit("end").alias("filename"), F.lit("image/jpeg").alias("content_type"),
        F.lit(0.0).alias("value"), F.lit("2100-01-01 00:00:00").cast("timestamp").alias("arrived"),
    )
    for part in (arrivals.where(day <= 10), arrivals.where((day > 10) & (day <= 20)), arrivals.where(day > 20), closing, closing):
        part.select(closing.columns).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(closing.schema).parquet(f"{root}/in")
        settled = uploads.settled_uploads(stream, "1 day", "1 hour")
        uploads.store_settled(settled, f"{root}/out", f"{root}/state").awaitTermination()
    stored = sinks.read_history(spark, f"{root}/out", "filename string, seq long, value double")
    return rounded(stored.select("filename", "seq", "value"), 6, "value")


@query("migrate_history", """
select l.image_name, l.nb_plates, l.status, case when l.original_image_path like 'images/%' then l.original_image_path else '' end as original_image_path,
 case when l.annotated_image_path is not null then l.annotated_image_path when l.original_image_path like '/9j/%'
  then concat('images/runs/migrated_', strftime(cast(l.timestamp as timestamp), '%Y%m%d_%H%M%S'), '/migrated_',
   substr(sha256(from_base64(l.original_image_path)), 1, 16), '_ann.jpg') else '' end as annotated_image_path
from fx_legacy l""")
def _(spark, d):
    moved, _artifacts = H.migrate_history(X.legacy_history(spark, d))
    return moved.drop("timestamp", "detections")


@query("migrated_artifacts", """
select distinct concat('images/runs/migrated_', strftime(cast(timestamp as timestamp), '%Y%m%d_%H%M%S'), '/migrated_',
 substr(sha256(from_base64(original_image_path)), 1, 16), '_ann.jpg') as path, hex(from_base64(original_image_path)) as content
from fx_legacy where original_image_path like '/9j/%'""")
def _(spark, d):
    _moved, artifacts = H.migrate_history(X.legacy_history(spark, d))
    return artifacts.withColumn("content", F.hex("content"))


@query("append_history", "select status, count(*) as n, sum(nb_plates)::bigint as plates from fx_history group by 1")
def _(spark, d):
    """Two writers with equal batch numbers, one of which writes a batch twice, as after a failure."""
    out = scratch_dir(spark, "history")
    rows = _history_table(spark, d)
    failed = F.col("status") != "success"
    sinks.append_history(rows.where(~failed), out, "first", 0)
    for _attempt in range(2):
        sinks.append_history(rows.where(failed), out, "second", 0)
    back = sinks.read_history(spark, out, HISTORY_SCHEMA)
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("nb_plates").alias("plates"))


@query("purge_history", "select count(*) as n_before, 0::bigint as n_after from fx_history")
def _(spark, d):
    out = scratch_dir(spark, "purged")
    sinks.append_history(_history_table(spark, d), out, "only", 0)
    before = sinks.read_history(spark, out, HISTORY_SCHEMA).select(F.lit(1).alias("before"), F.lit(0).alias("after"))
    counted = scratch_dir(spark, "purged-count")
    before.write.parquet(counted)
    sinks.purge_history(spark, out, HISTORY_SCHEMA)
    after = sinks.read_history(spark, out, HISTORY_SCHEMA).select(F.lit(0).alias("before"), F.lit(1).alias("after"))
    return spark.read.parquet(counted).unionByName(after).agg(
        F.sum("before").alias("n_before"), F.sum("after").alias("n_after")
    )


@query("artifact_paths", """
select event_id, case when event_type = 'error' then '' else concat(folder, '/', 'plate.', cast(event_id as string), '_orig.png') end as original_path,
 case when event_type = 'error' then '' else concat(folder, '/', 'plate.', cast(event_id as string), '_ann.jpg') end as annotated_path
from (select *, case when event_type = 'view' then concat('images/runs/run_', cast(user_id as string))
  else concat('images/', strftime(ts, '%Y/%m/%d'), '/', strftime(ts, '%Y%m%d_%H%M%S'), '_', lpad(cast(user_id as string), 8, '0')) end as folder from events)""")
def _(spark, d):
    events = X.table(spark, d, "events")
    run = F.when(F.col("event_type") == "view", F.concat(F.lit("run_"), F.col("user_id").cast("string")))
    folder = paths.artifact_folder(run, F.col("ts"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
    name = F.concat(F.lit("in/plate."), F.col("event_id").cast("string"), F.lit(".PNG"))
    ok = F.col("event_type") != "error"
    original, annotated = paths.artifact_paths(name, folder, ok, ok)
    return events.select("event_id", original.alias("original_path"), annotated.alias("annotated_path"))


@query("resolve_artifacts", """
select event_id, case when event_type in ('view', 'click') then cast(event_id as string) end as content from events""")
def _(spark, d):
    """Artifacts exist for views, clicks and signups; paths of signups climb out of the base folder."""
    events = X.table(spark, d, "events")
    path = F.concat(F.lit("images/runs/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"))
    climbing = F.concat(F.lit("images/../../"), F.col("event_id").cast("string"))
    named = events.select(
        "event_id", "event_type",
        F.when(F.col("event_type") == "signup", climbing).when(F.col("event_type") == "error", "").otherwise(path)
        .alias("original_image_path"),
    )
    stored = named.where(F.col("event_type").isin("view", "click", "signup")).select(
        F.col("original_image_path").alias("path"), F.col("event_id").cast("string").alias("content")
    )
    return H.resolve_artifacts(named, stored).select("event_id", "content")


# ---------------------------------------------------------------- training runs


@query("best_epoch", "select run_id, epoch, val_loss, is_best from fx_epochs")
def _(spark, d):
    return R.best_epoch(X.train_log(spark, d)).drop("logged_at")


@query("early_stop", """
select run_id, min(epoch) filter (where epoch - last_best >= 10) as stop_epoch, max(epoch) as last_epoch from (
 select *, max(case when is_best then epoch end) over (partition by run_id order by epoch) as last_best from fx_epochs) group by 1""")
def _(spark, d):
    return R.early_stop(X.train_log(spark, d))


def _decisions(spark, d) -> DataFrame:
    """Decisions on a stream of epochs that goes on from its checkpoint twice."""
    root = scratch_dir(spark, "followed")
    log = X.train_log(spark, d).select("run_id", "epoch", "val_loss")
    for part in ("epoch <= 15", "epoch > 15 and epoch <= 40", "epoch > 40"):
        log.where(part).write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
        followed.store_decisions(followed.follow_runs(stream), f"{root}/out", f"{root}/state").awaitTermination()
    schema = "run_id long, epoch int, val_loss double, is_best boolean, stop_epoch int"
    return sinks.read_history(spark, f"{root}/out", schema).drop("writer", "batch_id")


@query("stream_best_epoch", "select run_id, epoch, val_loss, is_best from fx_epochs")
def _(spark, d):
    return _decisions(spark, d).drop("stop_epoch")


@query("stream_early_stop", """
select run_id, min(epoch) filter (where epoch - last_best >= 10) as stop_epoch, max(epoch) as last_epoch from (
 select *, max(case when is_best then epoch end) over (partition by run_id order by epoch) as last_best from fx_epochs) group by 1""")
def _(spark, d):
    return followed.stops(_decisions(spark, d))


@query("run_summary", """
select run_id, count(*) as n_epochs, min(val_loss) as best_val_loss, arg_min(epoch, (val_loss, epoch)) as best_epoch, arg_max(val_loss, epoch) as last_val_loss,
 cast(floor(epoch(max(logged_at))) - floor(epoch(min(logged_at))) as bigint) as total_seconds from fx_train_log group by 1""")
def _(spark, d):
    return R.run_summary(X.train_log(spark, d))


@query("plateau_lr", """
fx_lr(run_id, epoch, best, bad, lr) as (
 select run_id, 0, 'inf'::double, 0, 0.001::double from fx_train_log where epoch = 1
 union all
 select l.run_id, l.epoch, case when l.val_loss < s.best * (1 - 1e-4) then l.val_loss else s.best end,
  case when l.val_loss < s.best * (1 - 1e-4) then 0 when s.bad + 1 > 5 then 0 else s.bad + 1 end,
  case when not l.val_loss < s.best * (1 - 1e-4) and s.bad + 1 > 5 and s.lr - greatest(s.lr * 0.5, 1e-6) > 1e-8 then greatest(s.lr * 0.5, 1e-6) else s.lr end
 from fx_lr s join fx_train_log l on l.run_id = s.run_id and l.epoch = s.epoch + 1)
select run_id, epoch, round(lr, 12) as lr from fx_lr where epoch > 0""", recursive=True)
def _(spark, d):
    return rounded(R.plateau_lr(X.train_log(spark, d)), 12, "lr")


def _metrics(spark, d) -> DataFrame:
    log = X.train_log(spark, d)
    names = ("train_loss", "train_cls_loss", "train_reg_loss", "val_loss", "val_cls_loss", "val_reg_loss")
    return log.select(
        "epoch", *[(F.col("val_loss") * (i + 1) / 7).alias(n) for i, n in enumerate(names)],
        (F.lit(0.001) / F.col("epoch")).alias("lr"), F.col("run_id").cast("string").alias("timestamp"),
    )


@query("append_epoch_log", """
select epoch, round(val_loss * 1 / 7, 4) as train_loss, round(val_loss * 4 / 7, 4) as val_loss, round(0.001 / epoch, 8) as lr,
 cast(run_id as string) as timestamp from fx_train_log""")
def _(spark, d):
    out = scratch_dir(spark, "epochs")
    sinks.append_epoch_log(_metrics(spark, d), out)
    back = files.scan_epoch_log(spark, out).select("epoch", "train_loss", "val_loss", "lr", "timestamp")
    return rounded(back, 4, "train_loss", "val_loss")


@query("scan_epoch_log", "select count(*) as n_rows, sum(epoch)::bigint as sum_epoch, round(sum(val_loss * 6 / 7), 2) as sum_reg from fx_train_log")
def _(spark, d):
    out = scratch_dir(spark, "epoch-scan")
    sinks.append_epoch_log(_metrics(spark, d), out)
    back = files.scan_epoch_log(spark, out).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("epoch").alias("sum_epoch"), F.sum("val_reg_loss").alias("sum_reg")
    )
    return rounded(back, 2, "sum_reg")


# ---------------------------------------------------------------- pixels

SIZES = "(select vec_id, 8 * (vec_id % 5 + 2) as width, 8 * (vec_id % 3 + 2) as height, vec_id % 11 = 0 as broken from embeddings)"


def _decoded(spark, d) -> DataFrame:
    return PX.decode_rgb(X.image_files(spark, d)).drop("content")


@query("decode_rgb", f"""
select vec_id, case when broken then -1 else width end::int as width, case when broken then -1 else height end::int as height,
 case when broken then -1 else width * height * 3 end::int as n_bytes, broken as failed from {SIZES}""")
def _(spark, d):
    return _decoded(spark, d).select(
        "vec_id", "pixels.width", "pixels.height", F.length("pixels.rgb").alias("n_bytes"),
        F.col("pixels.error").isNotNull().alias("failed"),
    ).fillna(-1)


FITTED_SQL = f"""
(select *, floor((256 - floor(width * scale)) / 2) / 256 as pad_x, floor((256 - floor(height * scale)) / 2) / 256 as pad_y
 from (select *, least(256.0::double / width, 256.0::double / height) as scale from {SIZES} where not broken))"""


# The same places and sizes for the one-colour pictures of `marked_files`, whose pixels SQL can write out as hex.
PAINTED_SQL = f"""
(select *, concat('vec_', cast(vec_id as string), '.png') as filename, lpad(hex(vec_id % {N.N_ANCHORS} // 64 * 10), 2, '0') as red,
  lpad(hex(vec_id % {N.N_ANCHORS} % 64 * 4), 2, '0') as green, floor(width * scale)::bigint as new_w, floor(height * scale)::bigint as new_h,
  (pad_x * 256)::bigint as gap_x, (pad_y * 256)::bigint as gap_y from {FITTED_SQL})"""


def _canvas_sql(colour: str, width: int) -> str:
    """Hex text of a fitted picture whose pixels take `width` bytes each: black rows above, rows with black ends, black rows below."""
    row = f"repeat('00', {width} * gap_x) || repeat({colour}, new_w) || repeat('00', {width} * (256 - gap_x - new_w))"
    return f"(repeat('00', {width} * 256 * gap_y) || repeat({row}, new_h) || repeat('00', {width} * 256 * (256 - gap_y - new_h)))"


RGB_SQL = "red || green || '00'"


def _painted(spark, d) -> DataFrame:
    return PX.decode_rgb(X.marked_files(spark, d)).drop("content")


@query("letterbox_resize", f"select filename, scale, pad_x, pad_y, sha256(from_hex({_canvas_sql(RGB_SQL, 3)})) as image_sha256 from {PAINTED_SQL}")
def _(spark, d):
    fitted = _painted(spark, d).withColumn("lb", PX.letterbox_resize(F.col("pixels")))
    return fitted.where(F.col("lb").isNotNull()).select(
        "filename", "lb.scale", "lb.pad_x", "lb.pad_y", F.sha2("lb.image", 256).alias("image_sha256")
    )


@query("stretch_resize", f"select filename, sha256(from_hex(repeat({RGB_SQL}, 65536))) as image_sha256 from {PAINTED_SQL}")
def _(spark, d):
    stretched = _painted(spark, d).withColumn("image", PX.stretch_resize(F.col("pixels")))
    return stretched.where(F.col("image").isNotNull()).select("filename", F.sha2("image", 256).alias("image_sha256"))


@query("normalize_tensor", f"""
select filename, 196608 as n_values, case when pad_x > 0 or pad_y > 0 then round((0 - 0.485) / 0.229, 4) end as corner,
 round((('0x' || green)::int / 255 - 0.456) / 0.224, 3) as middle_green,
 sha256(from_hex({_canvas_sql("red", 1)} || {_canvas_sql("green", 1)} || repeat('00', 65536))) as planes_sha256 from {PAINTED_SQL}""")
def _(spark, d):
    """Every value of the tensor, scaled back to a byte, plane by plane; two values as they are."""
    fitted = S.prepare(_painted(spark, d)).where(F.col("error").isNull())
    prepared = fitted.withColumn("tensor", PX.normalize_tensor(F.col("image")))
    padded = (F.col("pad_x") > 0) | (F.col("pad_y") > 0)
    out = prepared.select(
        "filename", F.size("tensor").alias("n_values"), F.when(padded, F.get("tensor", F.lit(0))).alias("corner"),
        F.get("tensor", F.lit(65536 + 128 * 256 + 128)).alias("middle_green"),
        F.sha2(X.tensor_bytes(F.col("tensor")), 256).alias("planes_sha256"),
    )
    return rounded(rounded(out, 4, "corner"), 3, "middle_green")


@query("unpack_struct", f"select vec_id, round(scale, 6) as scale, pad_x, pad_y from {FITTED_SQL}")
def _(spark, d):
    fitted = _decoded(spark, d).withColumn("lb", PX.letterbox_resize(F.col("pixels")))
    return rounded(A.unpack_struct(fitted, "lb", ["pixels", "filename"]).where("image is not null").drop("image"), 6, "scale")


@query("drop_failed_images", f"select vec_id from {SIZES} where not broken")
def _(spark, d):
    fitted = _decoded(spark, d).withColumn("image", PX.letterbox_resize(F.col("pixels"))["image"])
    return A.drop_failed_images(fitted).select("vec_id")


@query("base64_payload", f"select filename, sha256(to_base64(from_hex({_canvas_sql(RGB_SQL, 3)}))) as payload_sha256 from {PAINTED_SQL}")
def _(spark, d):
    image = PX.letterbox_resize(F.col("pixels"))["image"]
    fitted = A.drop_failed_images(_painted(spark, d).withColumn("image", image))
    return fitted.select("filename", F.sha2(PX.base64_payload(F.col("image")), 256).alias("payload_sha256"))


@query("annotate_plan", """
select event_id, number::int as number, x_min, y_min, x_max, y_max, '#00FF00' as box_color, 3 as box_width, x_min as label_x, y_min - 20 as label_y,
 concat('Plate ', cast(number as string), ': ', printf('%.2f', confidence)) as label from (
 select *, row_number() over (partition by event_id order by ord) as number from (
  select event_id, d.confidence, d.x_min, d.y_min, d.x_max, d.y_max, ord from (
   select event_id, unnest(ds) as d, generate_subscripts(ds, 1) as ord from (
    select event_id, from_json(replace(detections, '''', '"'),
     '[{"confidence":"DOUBLE","x_min":"INTEGER","y_min":"INTEGER","x_max":"INTEGER","y_max":"INTEGER"}]') as ds from fx_history))) )""")
def _(spark, d):
    return PX.annotate_plan(H.parsed_history(X.history(spark, d)).select("event_id", "detections"))


# ---------------------------------------------------------------- image trees written by Spark and read back

TREE = f"""
(select *, case when vec_id % 10 < 8 then 'train' when vec_id % 10 = 8 then 'valid' else 'test' end as split_name,
 case when vec_id % 10 < 8 then 0 when vec_id % 10 = 8 then 1 else 2 end::int as split_id, concat('vec_', cast(vec_id as string)) as image_name from {SIZES})"""


def _image_tree(spark, d) -> str:
    """A dataset folder: one image and one label file with two lines per embedding."""
    root = scratch_dir(spark, "tree")
    split = F.when(F.col("vec_id") % 10 < 8, "train").when(F.col("vec_id") % 10 == 8, "valid").otherwise("test")
    rows = X.image_files(spark, d).withColumns({"split": split, "name": F.concat(F.lit("vec_"), F.col("vec_id").cast("string"))})
    lines = F.concat(F.lit("0 0.5 0.5 0.2 0.1\n1 0."), F.lpad((F.col("vec_id") % 900 + 50).cast("string"), 3, "0"), F.lit(" 0.4 0.1 0.3\n"))

    def placed(kind: str, extension: str, content) -> DataFrame:
        path = F.concat("split", F.lit(f"/{kind}/"), "name", F.lit(extension))
        return rows.select(path.alias("path"), content.alias("content"))

    sinks.write_artifact_files(placed("images", ".jpg", F.col("content")), root)
    sinks.write_artifact_files(placed("labels", ".txt", F.encode(lines, "utf-8")), root)
    return root


@query("scan_images", f"select image_name, split_name, split_id, broken as is_short from {TREE}")
def _(spark, d):
    images = files.scan_images(spark, _image_tree(spark, d))
    return images.withColumn("is_short", F.length("raw_content") == 60).drop("raw_content")


@query("scan_label_names", f"""
select image_name, split_name, split_id, v.value from {TREE} t, lateral (select '0 0.5 0.5 0.2 0.1' as value
 union all select concat('1 0.', lpad(cast(t.vec_id % 900 + 50 as string), 3, '0'), ' 0.4 0.1 0.3')) v""")
def _(spark, d):
    """One label file per image, so that names are compared too."""
    return files.scan_label_lines(spark, _image_tree(spark, d))


@query("scan_inbox_names", "select concat('note ', cast(vec_id as string), '.txt') as filename, concat('note of ', cast(vec_id as string)) as body from embeddings")
def _(spark, d):
    root = scratch_dir(spark, "inbox-names")
    key = X.table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("key"))
    sinks.write_artifact_files(key.select(
        F.concat(F.lit("note "), "key", F.lit(".txt")).alias("path"), F.encode(F.concat(F.lit("note of "), "key"), "utf-8").alias("content")
    ), root)
    return files.scan_inbox(spark, root).select("filename", F.decode("image_bytes", "utf-8").alias("body"))


@query("scan_image_pixels", f"""
select image_name, split_name, case when broken then -1 else width end::int as width, case when broken then -1 else height end::int as height from {TREE}""")
def _(spark, d):
    images = files.scan_image_pixels(spark, _image_tree(spark, d))
    return images.select("image_name", "split_name", "image.width", "image.height")


@query("preprocess", f"""
select image_name, split_name, l.class_id, round(l.cx * (1 - 2 * pad_x) + pad_x, 5) as cx, round(l.h * (1 - 2 * pad_y), 5) as h from (
 select t.*, floor((256 - floor(width * scale)) / 2) / 256 as pad_x, floor((256 - floor(height * scale)) / 2) / 256 as pad_y
 from (select *, least(256.0::double / width, 256.0::double / height) as scale from {TREE} where not broken) t) t,
 lateral (select 0::double as class_id, 0.5::double as cx, 0.1::double as h
  union all select 1::double, (t.vec_id % 900 + 50) / 1000, 0.3::double) l""")
def _(spark, d):
    out = scratch_dir(spark, "preprocessed")
    preprocess.preprocess(spark, _image_tree(spark, d), out)
    boxes = files.read_training_table(spark, f"{out}/boxes")
    return rounded(boxes.select("image_name", "split_name", F.col("class_id").cast("double").alias("class_id"), "cx", "h"), 5, "cx", "h")


@query("score_inbox_stream", f"""
select concat('vec_', cast(vec_id as string), '.png') as image_name,
 case when broken then 'error: cannot identify image file' else 'success' end as status from {SIZES}""")
def _(spark, d):
    """All images arrive in an inbox; a second run of the stream finds nothing new."""
    root = scratch_dir(spark, "stream")
    arrived = X.image_files(spark, d).select(F.col("filename").alias("path"), "content")
    sinks.write_artifact_files(arrived, f"{root}/inbox")
    for _run in range(2):
        inbox.score_inbox_stream(
            spark, f"{root}/inbox", make_stub, f"{root}/history", f"{root}/state", score_threshold=0.5
        ).awaitTermination()
    return sinks.read_history(spark, f"{root}/history", "image_name string, status string").drop("writer", "batch_id")


# ---------------------------------------------------------------- scoring with a stand-in model


def _results(spark, d, threshold: float = 0.5) -> DataFrame:
    return S.run_scoring(_decoded(spark, d), make_stub, run="run_1", score_threshold=threshold)


def _marked(spark, d, **options) -> DataFrame:
    """Result rows of the images whose colour names their one box."""
    decoded = PX.decode_rgb(X.marked_files(spark, d)).drop("content")
    return S.run_scoring(decoded, make_marked, run="run_1", score_threshold=0.5, **options)


MARKED_SQL = f"""
(select filename, broken, coalesce(confidence, -1) as confidence, coalesce(x_min, -1) as x_min, coalesce(y_min, -1) as y_min,
  coalesce(x_max, -1) as x_max, coalesce(y_max, -1) as y_max from (
 select concat('vec_', cast(s.vec_id as string), '.png') as filename, s.broken,
  round(case when not s.broken then 1 / (1 + exp(-4.0::double)) end, 6) as confidence,
  {_back_sql('least(greatest(acx - aw / 2, 0), 1)', 'pad_x', 'f.width', 'x_min')}, {_back_sql('least(greatest(acy - ah / 2, 0), 1)', 'pad_y', 'f.height', 'y_min')},
  {_back_sql('least(greatest(acx + aw / 2, 0), 1)', 'pad_x', 'f.width', 'x_max')}, {_back_sql('least(greatest(acy + ah / 2, 0), 1)', 'pad_y', 'f.height', 'y_max')}
 from {SIZES} s left join {FITTED_SQL} f using (vec_id) join fx_anchors a on a.anchor_id = s.vec_id % {N.N_ANCHORS}))"""
FOUND = ("confidence", "x_min", "y_min", "x_max", "y_max")


@query("score_images", f"select filename, {', '.join(FOUND)} from {MARKED_SQL}")
def _(spark, d):
    decoded = PX.decode_rgb(X.marked_files(spark, d)).drop("content")
    scored = S.score_images(decoded, make_marked, 0.5)
    return rounded(H.explode_detections(scored.select("filename", "detections")), 6, "confidence").fillna(-1)


@query("run_scoring", f"""
select filename, case when broken then 'error: cannot identify image file' else 'success' end as status, not broken as success,
 case when broken then 0 else 1 end::int as nb_plates, 'run_1' as run_id, confidence as score, {', '.join(FOUND)} from {MARKED_SQL}""")
def _(spark, d):
    rows = _marked(spark, d).select("filename", "status", "success", "nb_plates", "run_id", F.get("scores", F.lit(0)).alias("score"), "detections")
    return rounded(H.explode_detections(rows), 6, "confidence", "score").fillna(-1)


@query("result_rows", f"""
select concat('vec_', cast(vec_id as string), '.png') as filename, case when broken then 'error: cannot identify image file' else 'success' end as status,
 not broken as success, 'run_1' as run_id from {SIZES}""")
def _(spark, d):
    return _results(spark, d).select("filename", "status", "success", "run_id")


@query("capture_errors", f"""
select concat('vec_', cast(vec_id as string), '.png') as filename, 'cannot identify image file' as error, 0 as nb_plates from {SIZES} where broken""")
def _(spark, d):
    return _results(spark, d).where(~F.col("success")).select("filename", "error", "nb_plates")


@query("predict_batch_simple", f"""
select case when broken then 0 else 1 end::int as nb_plates, case when broken then 0 else 1 end::int as n_scores, {', '.join(FOUND)} from {MARKED_SQL}""")
def _(spark, d):
    rows = S.predict_batch_simple(_marked(spark, d)).select("nb_plates", F.size("scores").alias("n_scores"), "detections")
    return rounded(H.explode_detections(rows), 6, "confidence").fillna(-1)


@query("scored_history", f"""
select concat('vec_', cast(vec_id as string), '.png') as image_name,
 case when broken then '' else concat('images/runs/run_1/vec_', cast(vec_id as string), '_orig.png') end as original_image_path,
 case when broken then '' else concat('images/runs/run_1/vec_', cast(vec_id as string), '_ann.jpg') end as annotated_image_path from {SIZES}""")
def _(spark, d):
    rows = S.history_rows(_results(spark, d), F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    return rows.select("image_name", "original_image_path", "annotated_image_path")


@query("write_predictions_csv", NMS_SQL.format(threshold=0.9, limit=100).replace(
    "select image_name, generate", "select image_name, '2026-01-01T00:00:00' as timestamp, 1 as class_id, generate"
).replace("unnest(kept).a as anchor_id, ", ""), recursive=True)
def _(spark, d):
    out = scratch_dir(spark, "predictions-csv")
    sinks.write_predictions_csv(D.predict(X.predictions_wide(spark, d), 0.9), out, "2026-01-01T00:00:00")
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    parsed = F.arrays_zip(
        F.from_json("predicted_boxes", "array<array<double>>").alias("box"),
        F.from_json("predicted_classes", "array<int>").alias("class_id"), F.from_json("scores", "array<double>").alias("score"),
    )
    rows = back.select("image_name", "timestamp", F.posexplode(parsed).alias("det_rank", "p"))
    cells = rows.select(
        "image_name", "timestamp", "det_rank", F.col("p.class_id").alias("class_id"), F.col("p.score").alias("score"),
        *[F.get("p.box", F.lit(i)).alias(c) for i, c in enumerate(D.CORNERS)],
    )
    return rounded(cells, 6, "score", *D.CORNERS)


@query("stored_artifacts", f"""
select filename as image_name, case when broken then 0 else 1 end::int as nb_plates, not broken as has_original, not broken as has_annotated,
 case when broken then '' else concat('images/runs/run_1/', replace(filename, '.png', '_orig.png')) end as original_image_path from {MARKED_SQL}""")
def _(spark, d):
    """The scoring job over an inbox; every path of its history is looked up among the stored files."""
    root = scratch_dir(spark, "scored-inbox")
    rows = X.marked_files(spark, d).select("filename", F.col("content").alias("image_bytes"))
    score.score_rows(
        rows, make_marked, "run_1", f"{root}/history", f"{root}/base", datetime(2026, 1, 1), score_threshold=0.5
    )
    history = sinks.read_history(spark, f"{root}/history", HISTORY_SCHEMA)
    stored = files.scan_artifacts(spark, f"{root}/base")
    kept = ["image_name", "nb_plates"]
    originals = H.resolve_artifacts(history, stored, "original_image_path").select(
        *kept, "original_image_path", F.col("content").isNotNull().alias("has_original")
    )
    annotated = H.resolve_artifacts(history, stored, "annotated_image_path").select(
        "image_name", F.col("content").isNotNull().alias("has_annotated")
    )
    return originals.join(annotated, "image_name")
