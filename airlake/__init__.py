"""airlake: air-traffic lake, marts, checks and analyses as Spark jobs."""

__version__ = "0.1.0"
