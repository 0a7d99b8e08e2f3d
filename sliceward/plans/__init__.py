from sliceward.plans.lifecycle import ArchiveLifecycle, Binding, Lifecycle, ReplicaLifecycle

__all__ = ["ArchiveLifecycle", "Binding", "Lifecycle", "ReplicaLifecycle"]
