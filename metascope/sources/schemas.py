"""Schemas of landed records, under the field names of the services' public APIs.

Each entry gives the array field of the page envelope and the type of one
record.  An absent field reads as NULL.  These are fixed values.
"""

ENVELOPES: dict[str, tuple[str, str]] = {
    "objects": (
        "Contents",
        "struct<Key:string,Size:bigint,LastModified:timestamp,StorageClass:string,ETag:string,"
        "Owner:struct<DisplayName:string>>",
    ),
    "catalog_tables": (
        "TableList",
        "struct<Name:string,TableType:string,CreateTime:timestamp,UpdateTime:timestamp,"
        "StorageDescriptor:struct<Location:string,InputFormat:string,OutputFormat:string,"
        "SerdeInfo:struct<SerializationLibrary:string>,Columns:array<struct<Name:string,Type:string>>>,"
        "PartitionKeys:array<struct<Name:string,Type:string>>,Parameters:map<string,string>>",
    ),
    "catalog_metadata": (
        "TableMetadataList",
        "struct<Name:string,CreateTime:timestamp,LastAccessTime:timestamp,TableType:string>",
    ),
    "jobs": (
        "Jobs",
        "struct<Name:string,Role:string,CreatedOn:timestamp,LastModifiedOn:timestamp,MaxCapacity:double,"
        "Description:string,Command:struct<Name:string,ScriptLocation:string>,MaxRetries:int,Timeout:int>",
    ),
    "job_runs": (
        "JobRuns",
        "struct<Id:string,JobName:string,JobRunState:string,StartedOn:timestamp,CompletedOn:timestamp,"
        "ExecutionTime:bigint>",
    ),
    "query_ids": ("QueryExecutionIds", "string"),
    "query_executions": (
        "QueryExecutions",
        "struct<QueryExecutionId:string,WorkGroup:string,"
        "Status:struct<State:string,SubmissionDateTime:timestamp,StateChangeReason:string>>",
    ),
    "pipeline_executions": (
        "PipelineExecutionSummaries",
        "struct<PipelineExecutionArn:string,PipelineExecutionStatus:string,StartTime:timestamp,"
        "LastModifiedTime:timestamp>",
    ),
    "training_jobs": (
        "TrainingJobSummaries",
        "struct<TrainingJobName:string,TrainingJobStatus:string,CreationTime:timestamp,"
        "TrainingEndTime:timestamp,TrainingTimeInSeconds:bigint>",
    ),
    "processing_jobs": (
        "ProcessingJobSummaries",
        "struct<ProcessingJobName:string,ProcessingJobStatus:string,CreationTime:timestamp,"
        "ProcessingEndTime:timestamp,ProcessingTimeInSeconds:bigint>",
    ),
    "transform_jobs": (
        "TransformJobSummaries",
        "struct<TransformJobName:string,TransformJobStatus:string,CreationTime:timestamp,"
        "TransformEndTime:timestamp>",
    ),
    "stacks": (
        "StackSummaries",
        "struct<StackName:string,StackId:string,CreationTime:timestamp,LastUpdatedTime:timestamp,"
        "DeletionTime:timestamp,StackStatus:string,StackStatusReason:string,TemplateDescription:string,"
        "DriftInformation:struct<StackDriftStatus:string,LastCheckTimestamp:timestamp>>",
    ),
    "streams": ("StreamNames", "string"),
    "state_machines": (
        "stateMachines",
        "struct<stateMachineArn:string,name:string,type:string,creationDate:timestamp>",
    ),
    "executions": (
        "executions",
        "struct<executionArn:string,stateMachineArn:string,name:string,status:string,startDate:timestamp>",
    ),
}

# Column name for the records of envelopes that hold plain text.
PLAIN_NAMES = {"streams": "StreamName", "query_ids": "QueryExecutionId"}

# Landed results of describe calls: one record per line, no envelope.
DETAILS: dict[str, str] = {
    "training_jobs": "TrainingJobName string, ResourceConfig struct<InstanceType:string,InstanceCount:int>, RoleArn string",
    "processing_jobs": "ProcessingJobName string, ProcessingResources struct<ClusterConfig:struct<InstanceType:string,"
    "InstanceCount:int>>, RoleArn string",
    "transform_jobs": "TransformJobName string, TransformResources struct<InstanceType:string,InstanceCount:int>, "
    "ModelName string",
    "streams": "StreamName string, StreamStatus string, StreamModeDetails struct<StreamMode:string>, "
    "RetentionPeriodHours int, Shards array<struct<ShardId:string>>, StreamCreationTimestamp timestamp, "
    "StreamARN string, EnhancedMonitoring array<struct<ShardLevelMetrics:array<string>>>",
    "state_machines": "stateMachineArn string, status string, roleArn string",
    "executions": "executionArn string, input string",
}

TAG_ROWS = "resource_id string, key string, value string, seq int"

PERSON = (
    "id string, name string, surname string, email string, age int, username string, occupation string, "
    "address struct<street:string,city:string,zipcode:string>"
)
