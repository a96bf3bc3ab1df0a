"""Analytics over labelled, gridded data as lazy Spark plans."""

from graticule.functions.bins import AxisStats, Binning
from graticule.model import coordinate_metadata, detect_roles, numeric_variables
from graticule.operators.comparison import (
    compare_grids,
    correlation_map,
    cross_variable,
    diff_levels,
    diff_periods,
    difference_limit,
    half_periods,
    overlay,
)
from graticule.operators.geometry import gradient, transect
from graticule.operators.maps import cross_section, hovmoller, map_mean, to_matrix
from graticule.operators.nearest import nearest_cells, nearest_frame, nearest_labels
from graticule.operators.percentile import percentiles
from graticule.operators.profiling import (
    axes_table,
    column_report,
    column_report_approx,
    column_sketches,
    dimension_profile,
    estimate_size,
    merged_report,
    schema_enums,
    schema_profile,
    table_metadata,
)
from graticule.operators.pyramid import Pyramid
from graticule.operators.reduction import (
    band_stats,
    calendar_stats,
    compare_means,
    contrast,
    coverage,
    grid_reduce,
    histogram,
    kde,
    overall_coverage,
    profile,
    reduce_dims,
    region_stats,
    summary,
    time_series,
    zone_stats,
)
from graticule.operators.regions import region_stats_many
from graticule.operators.rolling import rolling
from graticule.operators.selection import (
    bbox,
    convert_units,
    dim_slice,
    drop_missing,
    filter_ranges,
    frame_at,
    get,
    nearest_cell,
    sample_n,
    select_variables,
    time_steps,
    top_k,
)
from graticule.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketch_percentiles
from graticule.operators.spectral import peak_period, spectrum
from graticule.operators.temporal import (
    anomaly,
    climatology,
    climatology_table,
    grid_resample,
    resample,
    trend,
)
from graticule.plans.compose import ResultCache, chain, climate_series, preview
from graticule.plans.grid import Grid, isel, sel
from graticule.session import configure
from graticule.sources.chunks import axis_of, flatten_chunks
from graticule.sources.index import file_states, files_for, index_files, read_ranges, time_continuity
from graticule.sources.tables import read_many, read_table, write_table
from graticule.streaming.calendar import close_stream, resample_stream
from graticule.streaming.resample import stream_resample

__all__ = [name for name in dir() if not name.startswith("_")]
