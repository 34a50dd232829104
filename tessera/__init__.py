"""Labelled-image analytics as Spark jobs: tables of pixels, features, splits and scores."""
