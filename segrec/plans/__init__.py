from segrec.plans.pipeline import PipelineResult, RunResult, prepare_inputs, run_k, run_pipeline  # noqa: F401
