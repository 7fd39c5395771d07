"""Coupon and booking analytics as plain ``DataFrame -> DataFrame`` functions on Spark."""
