"""Sentiment facets of geotagged, timestamped short texts on Spark."""
