"""Tarn: surface-water metrics over raster time series, as Spark jobs."""
