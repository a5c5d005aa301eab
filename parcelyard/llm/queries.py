"""The operators as queries over the test tables, and SQL twins where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ball_codes, kd_shards, level_products, ngram_join, projection_forest, suffix_dedup, url_filter, voronoi_knn
from .ball_codes import op11_vector_codes
from .best_fit import op6_best_fit
from .class_lm import op2_class_lm
from .kd_shards import op12_kd_shards
from .level_products import op13_level_products
from .license_scan import op4_license_scan
from .mixing import op8_mixing
from .ngram_join import op9_ngram_join
from .projection_forest import op10_projection_forest
from .quality import op7_quality
from .suffix_dedup import op1_suffix_dedup
from .url_filter import op3_url_filter
from .voronoi_knn import op5_voronoi_knn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_class_lm,
        op3_url_filter,
        op4_license_scan,
        op5_voronoi_knn,
        op6_best_fit,
        op7_quality,
        op8_mixing,
        op9_ngram_join,
        op10_projection_forest,
        op11_vector_codes,
        op12_kd_shards,
        op13_level_products,
    )
}

ORACLE_SQL: dict[str, str] = url_filter.ORACLE_SQL | voronoi_knn.ORACLE_SQL | ball_codes.ORACLE_SQL | kd_shards.ORACLE_SQL | level_products.ORACLE_SQL | ngram_join.ORACLE_SQL | projection_forest.ORACLE_SQL | suffix_dedup.ORACLE_SQL
