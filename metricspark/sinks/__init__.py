from metricspark.sinks.results import collect_results, export_results, write_result

__all__ = ["collect_results", "export_results", "write_result"]
