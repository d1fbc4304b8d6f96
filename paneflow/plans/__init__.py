from paneflow.plans.batch import JobOutput, custom_window_job, event_time_job, ingestion_time_job

__all__ = ["JobOutput", "custom_window_job", "event_time_job", "ingestion_time_job"]
