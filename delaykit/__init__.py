"""Spark jobs and operators for delay analytics and delay-class prediction."""
